"""The corpus pipeline against its stages done plainly."""

import re

import duckdb
import pandas as pd

import brute
import corpus_pipeline
from fixtures_llm import ROWS
from txpulse.llm import decontaminate
from txpulse.llm.queries import ORACLES

SMALL = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    texts = dict(zip(docs.doc_id, docs.text))
    texts = {d: t for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    first = {}
    for d in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[d]), d)
    texts = {d: texts[d] for d in first.values()}
    roots = brute.jaccard(texts, 5, 4, 5)
    texts = {d: t for d, t in texts.items() if roots[d][1] == d}
    leaks = {d for d, _ in brute.overlaps(texts, items, decontaminate.WINDOW, decontaminate.allowed, decontaminate.MIN_WORDS)}
    assert leaks
    documents = docs[docs.doc_id.isin(set(texts) - leaks)]
    want = duckdb.sql(f"SELECT doc_id, taken FROM ({ORACLES['op2_mix']}) WHERE taken > 0").fetchall()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[: len(docs.columns)] == list(docs.columns)
    rows = out.collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted(want)
    assert [r.virtual_finish for r in rows] == sorted(r.virtual_finish for r in rows)
    assert isinstance(documents, pd.DataFrame)


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for table in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, table, SMALL)
            assert left.columns == table.columns, name
            assert left.count() <= len(ROWS)
    language = corpus_pipeline.identify_language(spark, odd, SMALL)
    assert {r.doc_id for r in language.collect()} >= {1, 2, 3, 7, 8}
    assert language.where("text IS NULL OR doc_id = 9").count() == 0
    assert corpus_pipeline.mix_sources(spark, none, SMALL).count() == 0
