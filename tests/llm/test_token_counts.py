"""Token counts against the libraries, and what the cache keeps."""

import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fixtures_llm import ROWS, frame
from txpulse.llm.common import temporary
from txpulse.llm.queries import QUERIES
from txpulse.llm import token_counts as T
from txpulse.llm.token_counts import TokenCache, TokenizerFile, count_tokens

BPE, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(path):
    if path.endswith(".json"):
        model = Tokenizer.from_file(path)
        return lambda t: len(model.encode(t or "", add_special_tokens=False).ids)
    model = SentencePieceProcessor(model_file=path)
    return lambda t: len(model.encode(t or ""))


@pytest.fixture
def cache(spark):
    return TokenCache(spark, temporary(spark, "token-cache"))


SPECIAL = [
    (20, "a<|endoftext|>b <|endoftext|>", None, None), (21, "naïve 漢字 😀 é   x", None, None),
    (22, "  leading,   inner \n\n and trailing  ", None, None), (23, "</s><s> <unk>", None, None), (24, "x" * 30_000, None, None),
]


@pytest.mark.parametrize("path", [BPE, PIECE, public_tokenizers.path("word_bpe_49k.json")])
def test_counts_are_the_librarys(spark, cache, path):
    rows = ROWS + SPECIAL
    count = plain(path)
    got = count_tokens(frame(spark, rows).repartition(3), TokenizerFile.read(path), cache, limit=20).collect()
    want = [(i, len((t or "").encode()), count(t), count(t) > 20) for i, t, *_ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_only_missing_contents_are_encoded(spark, cache, odd):
    tokenizer = TokenizerFile.read(BPE)
    first = count_tokens(odd, tokenizer, cache).collect()
    stored = lambda: spark.read.parquet(f"{cache.path}/tokenizer={tokenizer.digest}").count()
    assert stored() == len({t or "" for _, t, *_ in ROWS})
    again = count_tokens(odd, tokenizer, cache).collect()
    assert sorted(again, key=repr) == sorted(first, key=repr)
    assert stored() == len({t or "" for _, t, *_ in ROWS})
    count_tokens(frame(spark, [*ROWS, (99, "one more text", None, None)]), tokenizer, cache).collect()
    assert stored() == len({t or "" for _, t, *_ in ROWS}) + 1


def test_stored_counts_are_used(spark, cache):
    # a planted count shows that the text itself is not read again
    tokenizer = TokenizerFile.read(BPE)
    docs = frame(spark, [(1, "some text", None, None), (2, "other text", None, None)])
    planted = docs.where("doc_id = 1").select(F.sha2(F.col("text").cast("binary"), 256).alias("content"), F.lit(777).cast("long").alias("n_tokens"))
    cache.append(tokenizer, planted)
    cache.append(tokenizer, planted)  # stored twice, as after a failed run
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, tokenizer, cache).collect()} == {1: 777, 2: plain(BPE)("other text")}


def test_versions_do_not_mix(spark, cache):
    docs = frame(spark, [(1, "a few words of text", None, None)])
    got = [count_tokens(docs, TokenizerFile.read(p), cache).first().n_tokens for p in (BPE, PIECE)]
    assert got == [plain(BPE)("a few words of text"), plain(PIECE)("a few words of text")]
    assert TokenizerFile.read(BPE).digest != TokenizerFile.read(PIECE).digest


def test_empty_table(spark, cache, none):
    tokenizer = TokenizerFile.read(BPE)
    assert count_tokens(none, tokenizer, cache).count() == 0
    assert cache.counts(tokenizer).count() == 0


def test_unknown_files(tmp_path):
    with pytest.raises(ValueError):
        TokenizerFile.read(str(tmp_path / "x.bin"))


def test_query_equals_library(spark, texts):
    count = plain(BPE)
    got = QUERIES["op12_token_counts"](spark, "/root/testdata/sf0.001").collect()
    want = [(i, len((t or "").encode()), count(t), count(t) > 512) for i, t in texts.items()]
    assert sorted(map(tuple, got)) == sorted(want)


MIXED = st.lists(
    st.sampled_from([" ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "'s", "'", "don't", "<|endoftext|>", "<|", "word", "Wort", "é", "e\u0301", "漢字", "12", "٣", "!?", "😀", "\u200b", "."])
    | st.text(max_size=3),
    max_size=25,
).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=4))
def test_pieces_add_up_to_the_text(texts):
    count = TokenizerFile.read(BPE).counter()
    assert isinstance(count, T.PieceCounter)
    assert count(texts) == [plain_bpe(t) for t in texts]


plain_bpe = plain(BPE)


def test_pieces_are_forgotten_in_time(monkeypatch):
    monkeypatch.setattr(T, "MOST_PIECES", 3)
    count = T.PieceCounter(lambda xs: [len(x) for x in xs])
    assert [count([f"a{i} b{i} c"]) for i in range(9)] == [[7]] * 9
    assert len(count.known) <= 6


def test_which_vocabularies_allow_pieces():
    bpe = json.loads(open(BPE).read())
    assert T._cuttable(bpe)
    changes = [("normalizer", {"type": "NFC"}), ("pre_tokenizer", None), ("pre_tokenizer", bpe["pre_tokenizer"] | {"add_prefix_space": True})]
    changes += [("added_tokens", [bpe["added_tokens"][0] | {"rstrip": True}]), ("added_tokens", [bpe["added_tokens"][0] | {"content": "a b"}])]
    assert not any(T._cuttable(bpe | {k: v}) for k, v in changes)
    assert not T._cuttable(json.loads(open(public_tokenizers.path("word_bpe_49k.json")).read()))
