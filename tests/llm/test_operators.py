"""Whole operators against brute force, and on odd, repeated and empty rows."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from fixtures_llm import BASE, ROWS, frame
from oracle_compare import compare, duck
from txpulse.llm import decontaminate, exact_dedup, graph, html_extract, jaccard_join, language_id, line_dedup, mixing, quality, span_dedup, url_filter
from txpulse.llm.common import word_count
from txpulse.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name])
    assert ok, msg


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)] + [(3, 3)]
    groups = brute.Groups({x for p in links for x in p})
    for a, b in links:
        groups.join(a, b)
    got = {r.u: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: groups.find(x) for x in groups.up if groups.find(x) != x}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_exact_dedup_odd(odd, none):
    got = exact_dedup.exact_groups(odd)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    by = {}
    for r in ROWS:
        by.setdefault(norm(r[1]), []).append(r[0])
    want = []
    for text, ids in by.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        kept = False
        for i in known + [None] * (len(ids) - len(known)):
            want.append((i, keep, len(ids), i == keep and not kept, hashlib.sha256(text.encode()).hexdigest()))
            kept = kept or i == keep
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_groups(none).count() == 0
    left = exact_dedup.keep_first(odd)
    assert left.columns == odd.columns
    assert rows(left, "doc_id", "text") == sorted({(w[0], t) for w in want if w[3] for i, t, *_ in ROWS if i == w[0] and hashlib.sha256(norm(t).encode()).hexdigest() == w[4]}, key=repr)


def test_mix_odd(odd, none):
    plan = mixing.mix_plan(odd, word_count(F.col("text"))).collect()
    assert len(plan) == len(ROWS)
    assert sorted(r["size"] for r in plan) == sorted(len(brute.WORD.findall(r[1] or "")) for r in ROWS)
    assert all(r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in plan)
    assert sum(r.taken for r in plan) <= sum(r["size"] for r in plan)
    assert rows(mixing.mix_plan(odd.repartition(7), word_count(F.col("text"))), "doc_id", "size", "taken") == sorted(((r.doc_id, r["size"], r.taken) for r in plan), key=repr)
    assert mixing.mix_plan(none, word_count(F.col("text"))).count() == 0
    mixed = mixing.mixed_documents(odd, word_count(F.col("text")))
    assert mixed.columns == [*odd.columns, "size_", "target_", "taken_", "virtual_finish"]
    assert mixed.count() == sum(r.taken > 0 for r in plan)


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.mix_plan(docs, word_count(F.col("text"))).join(docs.select("doc_id", "source"), "doc_id")
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect():
        assert abs(r.t - r.g) <= 2 * r.m


def test_jaccard_brute(documents, texts):
    for k, num, den in ((3, 90, 100), (5, 4, 5), (2, 1, 2)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents, k, num, den).collect()}
        assert got == brute.jaccard(texts, k, num, den)


def test_jaccard_chains_and_large_groups(spark):
    """Near copies of which many link only through others, and lists shared by texts that do not link."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    base = [word() for _ in range(60)]
    texts = {}
    for i in range(250):
        own = list(base)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(60)] = word()
        texts[i] = " ".join(own)
    passage = [word() for _ in range(40)]
    for i in range(250, 400):
        texts[i] = " ".join(passage + [word() for _ in range(rng.randrange(3, 25))])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 90, 100).collect()}
    want = brute.jaccard(texts, 3, 90, 100)
    assert got == want and len({c for _, c in want.values()}) > 100


def test_jaccard_odd(odd, none):
    got = rows(jaccard_join.jaccard_components(odd, 3, 90, 100), "doc_id", "n_shingles", "component_id")
    assert len(got) == len(ROWS)
    of = {}
    for i, n, c in got:
        of.setdefault(i, []).append((n, c))
    assert of[1] == of[2] and of[1][0][1] == 1 and of[3] == [(len(brute.shingles(BASE, 3)) + 1, 1)] * 2
    assert of[4] == of[5] == of[6] == [(0, 4)] or (of[4], of[5], of[6]) == ([(0, 4)], [(0, 5)], [(0, 6)])
    assert of[7][0][1] == of[8][0][1] == 7
    assert sorted(of[None], key=repr) == sorted([(len(brute.shingles(BASE, 3)), 1), (0, None)], key=repr)
    assert jaccard_join.jaccard_components(none, 3, 90, 100).count() == 0
    assert jaccard_join.keep_one(odd).columns == odd.columns


def test_keep_one_of_rows_that_share_an_id(spark):
    """A clean text stays though another row with its id is a near copy."""
    rng = random.Random(21)
    say = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    first, clean, other = say(), say(), say()
    docs = [(1, first, "a"), (2, f"{first} end", "b"), (2, clean, "c"), (2, "", "d"), (3, f"{first} so", "e"), (4, other, "f"), (None, other, "g")]
    df = spark.createDataFrame(docs, "doc_id long, text string, cid string").repartition(3)
    left = jaccard_join.keep_one(df)
    assert left.columns == df.columns
    assert sorted(r.cid for r in left.collect()) == ["a", "c", "d", "f", "g"]


def test_lines_brute(spark, texts):
    rng = random.Random(4)
    cases = dict(list(texts.items())[:80])
    sample = [x for t in cases.values() for x in t.split("\n") if len(x) >= line_dedup.LEAST_CHARS][:60]
    for i, line in enumerate(sample):  # near copies up to three edits away, some in one document
        own = list(line)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = rng.choice("xyz")
        cases[1000 + i // 2] = cases.get(1000 + i // 2, "") + "".join(own) + "\n \n"
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, list(r.dropped)) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == brute.lines(cases, line_dedup.EDITS, line_dedup.LEAST_CHARS)


def test_lines_with_a_common_segment(spark):
    """Many lines share a long first part and do not link; groups link through chains."""
    rng = random.Random(9)
    head = "this very first part of the line is the same for all of them and it is long "
    cases = {i: head + "".join(rng.choice("abcdefgh") for _ in range(30)) for i in range(80)}
    chain = "x" * 20 + "".join(rng.choice("ijklmnop") for _ in range(60))
    for i in range(100, 130):
        at = rng.randrange(len(chain))
        chain = chain[:at] + "#" + chain[at + 1 :]
        cases[i] = chain
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, list(r.dropped)) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == brute.lines(cases, line_dedup.EDITS, line_dedup.LEAST_CHARS)
    assert sum(n for n in (len(v[1]) for v in got.values())) >= 29


def test_lines_share_brute(spark):
    """The threshold grows with the shorter line's length, and short lines have one too."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(["er", "in", "the", "ü", "an", "on", "sta"]) for _ in range(rng.randrange(1, 5)))
    lines = [" ".join(word() for _ in range(rng.choice((2, 4, 6, 12, 20, 50)))) for _ in range(60)] + ["hah " * 30, "x" * 25]
    for line in list(lines):
        for share in (40, 20, 15):  # edits spread evenly, in clumps or by chance, around the threshold
            own, n = list(line), len(line) // share + rng.randrange(2)
            where = rng.choice((lambda j: j * len(own) // (n + 1), lambda j: j, lambda j: rng.randrange(len(own))))
            for j in range(n):
                at = min(where(j), len(own) - 1)
                kind = rng.randrange(3)
                own[at : at + (kind > 0)] = [rng.choice("qzé")] * (kind < 2)
            lines.append("".join(own).strip())
    rng.shuffle(lines)
    cases = {i: f"{line}\n" for i, line in enumerate(lines)}
    groups, distinct = brute.Groups(lines), sorted(set(lines), key=len)
    for i, a in enumerate(distinct):
        most = len(a) // line_dedup.SHARE
        for b in distinct[i + 1 :]:
            if len(b) - len(a) <= most and sum((Counter(b) - Counter(a)).values()) <= most and brute.edits(a, b) <= most:
                groups.join(a, b)
    seen, want = set(), {}
    for i, line in enumerate(lines):
        want[i] = (1, [0] if groups.find(line) in seen else [])
        seen.add(groups.find(line))
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, list(r.dropped)) for r in line_dedup.repeated_lines(docs, share=line_dedup.SHARE).collect()}
    assert got == want and 60 < sum(len(v[1]) for v in want.values()) < len(lines) - 60


def test_lines_share_long(spark):
    """Places in a line of 300,000 characters are beyond 31 bits when multiplied; bytes that are no text stay bytes."""
    rng = random.Random(8)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)) + "x"
    long, short = say(300_000), say(90)
    docs = [(1, f"{long}\n{short}"), (2, f"{say(90)}\n{short[:40]}!{short[40:]}"), (3, long)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bad = spark.createDataFrame([(4, bytearray(b"\xff\xfe and a line of forty characters \xc3( so")), (5, bytearray(b"\xff\xfe and a line of forty characterz \xc3( so"))], "doc_id long, text binary")
    df = df.union(bad.selectExpr("doc_id", "cast(text as string)"))
    got = {r.doc_id: (r.n_lines, list(r.dropped)) for r in line_dedup.repeated_lines(df, share=line_dedup.SHARE).collect()}
    assert got == {1: (2, []), 2: (2, [1]), 3: (1, [0]), 4: (1, []), 5: (1, [0])}


def test_lines_share_rounds(spark, monkeypatch):
    """The rounds of lengths decide as one does, and places without a segment like them go no further than the filter."""
    rng = random.Random(14)
    say = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n)) + "x"
    lines = [say(n) for n in range(20, 400)]
    near = [x[: len(x) // 2] + "QRSTUVWXYZ"[: len(x) // 20] + x[len(x) // 2 :] for x in lines]  # into the next round, some
    df = spark.createDataFrame(list(enumerate([*lines, *near])), "doc_id long, text string").repartition(2)
    rows, written = {}, line_dedup.written

    def counted(table, name):
        out = written(table, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    monkeypatch.setattr(line_dedup, "MOST", 300)
    got = {r.doc_id: r.n_dropped for r in line_dedup.repeated_lines(df, share=line_dedup.SHARE).collect()}
    assert got == {i: int(i >= len(lines)) for i in range(2 * len(lines))}
    assert 0 < rows["hits"] < sum(map(len, [*lines, *near])) // 10


def test_lines_odd(odd, none):
    got = {r.doc_id: (r.n_lines, r.n_dropped, list(r.dropped)) for r in line_dedup.repeated_lines(odd).collect()}
    assert set(got) == {r[0] for r in ROWS}
    assert got[4] == got[5] == got[6] == (0, 0, []) and got[1] == (1, 0, []) and got[8] == (1, 1, [0])
    assert got[None] == (1, 1, [0])
    assert line_dedup.repeated_lines(none).count() == 0
    cut = line_dedup.without_lines(odd)
    assert cut.columns == odd.columns and cut.count() == len(ROWS)
    assert {r.text for r in cut.where("doc_id = 8").collect()} == {""}


def test_decontaminate_brute(spark, documents, texts):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rng = random.Random(6)
    cases = {d: t for d, t in texts.items() if len(t) < 1500}
    for i, t in list(items.items())[:25]:  # planted with words replaced, or in part
        w = t.split()
        for _ in range(len(w) // rng.choice((5, 7, 12))):
            w[rng.randrange(len(w))] = "changed"
        cut = w[: rng.choice((8, 14, len(w)))]
        cases[5000 + i] = "some words in front of it " + " ".join(cut) + " and some after"
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_spans(docs, bench).collect()}
    want = brute.overlaps(cases, items, decontaminate.WINDOW, decontaminate.allowed, decontaminate.MIN_WORDS)
    assert got == want and len(want) > 10
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert left == set(cases) - {d for d, _ in want}


def test_decontaminate_blocks_and_odd(spark, odd, none, monkeypatch):
    bench = spark.createDataFrame([(1, BASE), (1, BASE), (2, None), (None, "Größe und"), (3, "")], "item_id long, text string")
    want = rows(decontaminate.contaminated_spans(odd, bench), "doc_id", "item_id", "n_words")
    assert {(d, i) for d, i, _ in want} == {(1, 1), (2, 1), (3, 1), (None, 1)}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert rows(decontaminate.contaminated_spans(odd, bench), "doc_id", "item_id", "n_words") == want
    assert decontaminate.contaminated_spans(none, bench).count() == 0
    assert decontaminate.contaminated_spans(odd, bench.limit(0)).count() == 0
    left = decontaminate.drop_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == len(ROWS) - 5


def test_language_id(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = language_id.identify(docs).where("held_out")
    r = judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("a"), F.min("score").alias("s")).first()
    assert r.a > 0.98 and r.s > 0.2
    got = language_id.identify(odd)
    assert got.columns == [*odd.columns, "held_out_", "lang_pred_", "score_"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred_ == "und") == (not letters) and 0 <= r.score_ <= 1
    assert language_id.identify(none).count() == 0
    none_learned = language_id.identify(odd.where("lang is null")).select("lang_pred_").distinct().collect()
    assert [x[0] for x in none_learned] == ["und"]


def test_every_label_is_learned(spark):
    rng, names = random.Random(8), set()
    while len(names) < 260:
        names.add("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)))
    docs = [(i, f"{n} {n[:6]} {n[3:]} " * 3, n) for i, n in enumerate(sorted(names) * 6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    got = language_id.identify(df).where("held_out").select("lang", "lang_pred").collect()
    assert len({r.lang for r in got}) > 200 and all(r.lang == r.lang_pred for r in got)


def test_label_and_source_are_no_inputs(documents):
    as_is = language_id.identify(documents.where(~language_id.held_out(F.col("doc_id"))).union(documents.where(language_id.held_out(F.col("doc_id"))).withColumn("lang", F.lit(None).cast("string"))))
    assert rows(as_is, "doc_id", "lang_pred", "score") == rows(language_id.identify(documents), "doc_id", "lang_pred", "score")


def test_quality_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    graded = labels.select(F.col("doc_id").alias("id"), quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    got = quality.grade_documents(docs, graded.where("id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    kept = {(r.quality, r.toxic): r.s for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("selected").cast("int")).alias("s")).collect()}
    assert kept[1, 0] > 0.97 and kept[0, 0] < 0.1 and kept[1, 1] < 0.35  # 2,000 ratings only
    ratings = spark.createDataFrame([(1, 2), (1, 2), (7, 0), (9, 1), (None, 2), (3, None)], "id long, grade int")
    got = quality.grade_documents(odd, ratings)
    assert got.columns == [*odd.columns, "expected_grade_", "tail_probability_", "selected_"]
    assert all(0 <= r.tail_probability_ <= 1 for r in got.collect()) and got.count() == len(ROWS)
    assert quality.grade_documents(none, ratings).count() == 0
    assert quality.grade_documents(odd, ratings.limit(0)).select("expected_grade_").distinct().count() == 1


def test_spans_brute(documents, texts):
    """Every repeated span of the operator's own cut goes from all but its first document."""
    import pyarrow as pa

    first, covered = {}, {}
    for d in sorted(texts):
        _, h, _, n, start, end = span_dedup.spans(pa.array([texts[d]], pa.large_string()))
        for x, k, a, b in zip(h.tolist(), n.tolist(), start.tolist(), end.tolist()):
            if first.setdefault((x, k), d) != d or (x, k, d) in covered:
                covered.setdefault(d, []).append((a, b))
            covered[x, k, d] = True
    want = {}
    for d in texts:
        merged = []
        for a, b in sorted(covered.get(d, [])):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want.update({(d, a): b for a, b in merged})
    got = {(r.doc_id, r.start): r.stop for r in span_dedup.repeated_passages(documents).collect()}
    assert got == want and want


def test_spans_odd(odd, none):
    got = span_dedup.repeated_passages(odd)
    assert {r.doc_id for r in got.collect()} <= {None, 2, 7, 8} and {8} <= {r.doc_id for r in got.collect()}
    assert span_dedup.repeated_passages(none).count() == 0
    cut = span_dedup.without_passages(odd)
    assert cut.columns == odd.columns and cut.count() == len(ROWS)
    left = {r.doc_id: r.text for r in cut.where("doc_id in (7, 8)").collect()}
    assert len(left[8]) < len(left[7]) <= len(ROWS[7][1])


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    import html as html_module

    for r, want in zip(html_extract.extract_pages(pages).orderBy("page_id").collect(), pages.orderBy("page_id").collect()):
        inner = want.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1|h2|ul|li|div)>", inner)
        parts = [" ".join(html_module.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text) and r.url == want.url
    odd = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>a &lt; b</p>", "y"), (2, "", "", None)], "page_id long, url string, html string, text string")
    assert rows(html_extract.extract_pages(odd), "page_id", "text", "n_chars") == [(1, "", 0), (1, "", 0), (2, "", 0), (None, "a < b", 5)]
    assert html_extract.extract_pages(odd.limit(0)).count() == 0


def test_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == pages.count() and {r.verdict for r in got} == {"allow", "block"}
    assert all(r.verdict == ("block" if r.rule in ("example.org/es/", "example.org/en/1", "com/de/") else "allow") for r in got if r.rule)
    odd = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "http://x.org/", "b"), (2, "", "c"), (3, "x" * 200_000, "d")], "page_id long, url string, host string")
    assert rows(url_filter.judge_urls(odd), "page_id", "host", "rule", "verdict")[:2] == [(1, "", None, "allow")] * 2
    assert url_filter.judge_urls(odd.limit(0)).count() == 0


def test_mixed_documents_keep_the_budget_when_ids_repeat(spark):
    # 600 rows, 200 ids in each of three sources
    rng = random.Random(8)
    data = [(i, " ".join(["w"] * rng.choice([5, 10, 10, 20])), "en", s) for s in ("a", "b", "c") for i in range(200)]
    docs = frame(spark, data, clash=False)
    size = word_count(F.col("text"))
    plan = {}
    for r in mixing._plan(docs, size, "doc_id", "source", mixing.WEIGHTS, mixing.EPOCHS, "mix").where("taken > 0").collect():
        plan[r.id, r.source] = (r["size"], r.target, r.taken, r.virtual_finish)
    mixed = mixing.mixed_documents(docs.repartition(5), size).collect()
    assert {(r.doc_id, r.source): (r["size"], r.target, r.taken, r.virtual_finish) for r in mixed} == plan
    assert len(mixed) == len(plan)
    total = sum(len(t.split()) for _, t, _, _ in data)
    assert total - 60 <= sum(r.taken for r in mixed) <= total
    assert all(r.taken <= 3 * r["size"] for r in mixed)
    for s in "abc":
        own = [r for r in mixed if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 60


def test_scopes_remove_their_tables(spark):
    from txpulse.llm import common

    def there(df):
        import os

        return os.path.exists(df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0])

    with common.scope(spark):
        a = common.written(spark.range(3), "a")
        with common.scope(spark):
            b = common.written(spark.range(3), "b")
            c = common.kept(b, "c")
            files = b.inputFiles()[0]
        assert there(a) and there(c) and c.count() == 3
        import os

        assert not os.path.exists(files.replace("file://", ""))
        gone = c.inputFiles()[0]
    assert not os.path.exists(gone.replace("file://", ""))
