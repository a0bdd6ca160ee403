"""Registered queries of the text operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from txpulse.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    line_dedup,
    merkle,
    mixing,
    periodic_runs,
    quality,
    span_dedup,
    token_counts,
    url_filter,
)
from txpulse.llm.common import table, temporary, word_count


def op1_decontaminate(spark, sf_dir):
    return decontaminate.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_plan(docs, word_count(F.col("text"))).drop("virtual_finish")


def op3_line_dedup(spark, sf_dir):
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"), share=line_dedup.SHARE)


def op4_html_extract(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op7_quality(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select(F.col("doc_id").alias("id"), quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.grade_documents(docs, ratings).drop("text")


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op9_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_span_dedup(spark, sf_dir):
    return span_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf_digest([*map(F.col, fields[:-1]), text])
    proofs = merkle.manifest(docs, fields, carry={"tampered": tampered}).proofs
    folded = proofs.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_token_counts(spark, sf_dir):
    tokenizer = token_counts.TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"))
    cache = token_counts.TokenCache(spark, temporary(spark, "token-cache"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer, cache)


def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = docs.withColumn("text", periodic_runs.with_planted_runs(F.col("text"), F.col("doc_id")))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(planted))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_mix, op3_line_dedup, op4_html_extract, op5_exact_dedup,
        op6_language_id, op7_quality, op8_jaccard_join, op9_url_filter, op10_span_dedup,
        op11_merkle_manifest, op12_token_counts, op13_periodic_runs,
    )
}

def _merkle_sql(levels: int = 16, top_levels: int = 10) -> str:
    """The trees level by level, for up to 3**levels documents a source and 3**top_levels sources."""

    def fields(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, depth: int) -> list[str]:
        """Levels of ``name``0 (tree, i, d); steps (k, tree, i, l, r) of all nodes that have one above."""
        out = []
        for k in range(depth):
            near = "string_agg(d, '') OVER (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN"
            out.append(
                f"{name}s{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS n, "
                f"coalesce({near} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce({near} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            out.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // 3 AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) "
                f"ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}s{k} GROUP BY tree, i // 3)"
            )
        return out

    def climb(start: str, name: str, depth: int, tag: str) -> list[str]:
        """From ``start`` (tree, i, f, proof, ...) up the levels of ``name``."""
        out = []
        for k in range(depth):
            last = start if k == 0 else f"{tag}{k}"
            out.append(
                f"{tag}{k + 1} AS MATERIALIZED (SELECT c.* REPLACE (c.i // 3 AS i, CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f, "
                f"CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof) "
                f"FROM {last} c JOIN {name}s{k} s ON c.tree IS NOT DISTINCT FROM s.tree AND c.i = s.i)"
            )
        return out

    bits = "flatten([[(ascii(c) >> k) & 1 for k in range(8)] for c in string_split(CAST(doc_id AS VARCHAR), '')])"
    crc = f"list_reduce(list_prepend(4294967295, {bits}), lambda c, b: xor(c >> 1, CASE WHEN (c & 1) != b THEN 3988292384 ELSE 0 END))"
    return "WITH " + ",\n".join(
        [
            f"leaves AS MATERIALIZED (SELECT doc_id, source, {fields('text')} AS leaf, CASE WHEN xor({crc}, 4294967295) % 2 = 0 "
            f"THEN {fields("replace(text, chr(10), '')")} ELSE {fields('text')} END AS f FROM documents)",
            "placed AS MATERIALIZED (SELECT *, source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)",
            "a0 AS MATERIALIZED (SELECT tree, i, leaf AS d FROM placed)",
            *tree("a", levels),
            f"b0 AS MATERIALIZED (SELECT 0 AS tree, tree AS source, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, d FROM a{levels})",
            *tree("b", top_levels),
            "c0 AS MATERIALIZED (SELECT doc_id, source, tree, i, leaf, f, '' AS proof FROM placed)",
            *climb("c0", "a", levels, "c"),
            f"e0 AS MATERIALIZED (SELECT c.* REPLACE (b.tree AS tree, b.i AS i), b.d AS subroot FROM c{levels} c JOIN b0 b ON c.source IS NOT DISTINCT FROM b.source)",
            *climb("e0", "b", top_levels, "e"),
        ]
    ) + (
        f"\nSELECT doc_id, leaf, subroot, b.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b.d AS verified "
        f"FROM e{top_levels} e JOIN b{top_levels} b ON e.tree = b.tree"
    )


ORACLES = {
    "op11_merkle_manifest": _merkle_sql(),
    "op2_mix": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS most FROM per),
lined AS (
  SELECT *, row_number() OVER w AS nth,
         (SELECT sum(source_size) FROM per) - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS heft
  FROM weighed WINDOW w AS (ORDER BY CAST(most AS DOUBLE) / weight, rank)),
level AS (SELECT remaining, heft FROM lined WHERE NOT remaining * weight > most * heft ORDER BY nth LIMIT 1),
targets AS (
  SELECT source, rank, source_size,
         CASE WHEN l.remaining * weight > most * l.heft THEN CAST(most AS DOUBLE)
              ELSE CAST(v.remaining AS DOUBLE) * weight / v.heft END AS target
  FROM lined l, level v),
timed AS (
  SELECT s.*, t.rank, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT doc_id, key, rank, size, CAST(e * source_size + upto AS DOUBLE) / target AS finish
  FROM timed, (VALUES (0), (1), (2)) x(e) WHERE target > 0 AND size > 0),
summed AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, key, doc_id, size) AS total FROM entries),
repeats AS (
  SELECT DISTINCT doc_id, key, rank, size, finish FROM summed WHERE total <= (SELECT sum(size) FROM sized)),
counted AS (SELECT doc_id, rank, size, count(*) AS n FROM repeats GROUP BY ALL)
SELECT t.doc_id, t.size, t.source_size, t.target, CAST(t.size * coalesce(c.n, 0) AS BIGINT) AS taken
FROM timed t LEFT JOIN counted c
  ON t.doc_id IS NOT DISTINCT FROM c.doc_id AND t.rank = c.rank AND t.size = c.size""",
    "op5_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t,
         row_number() OVER (PARTITION BY t ORDER BY doc_id) AS nth FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       nth = 1 AS kept, sha256(t) AS text_sha256
FROM n""",
}
