"""Token counts through a cache of content and tokenizer digests."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.llm.common import slices, written

#: A vocabulary file is sent to every executor, so its size is bounded.
MOST_VOCABULARY_BYTES = 256 << 20

CACHE = "content string, n_tokens long"

#: Counts of pieces that a worker process holds at once.
MOST_PIECES = 1 << 19

_counters: dict[str, Callable] = {}


def _cuttable(vocabulary: dict) -> bool:
    """Whether texts may be cut before a single space between two characters that are no space.

    The byte-level pattern ends a word before such a space and begins the next
    one with it, whatever stands around, so the pieces' tokens are the text's.
    That needs the text as it is (no normaliser, no added first space), no
    template, and added tokens that hold no space and take none along.
    """
    split = vocabulary.get("pre_tokenizer") or {}
    plain = not any(vocabulary.get(k) for k in ("normalizer", "post_processor"))
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    added = all(
        not re.search(r"\s", t["content"]) and not any(t.get(k) for k in ("lstrip", "rstrip", "single_word"))
        for t in vocabulary.get("added_tokens", ())
    )
    return plain and byte_level and added and not vocabulary["model"].get("dropout")


class PieceCounter:
    """Counts of texts from those of their pieces; each piece is encoded once while the worker remembers it."""

    def __init__(self, count: Callable[[list[str]], list[int]]):
        self.count = count
        self.known: dict[str, int] = {}
        self.cut = re.compile(r"(?<=\S)(?= \S)")

    def __call__(self, texts: list[str]) -> list[int]:
        pieces = [self.cut.split(t) for t in texts]
        if len(self.known) > MOST_PIECES:
            self.known = {}
        new = list({x for p in pieces for x in p} - self.known.keys())
        self.known.update(zip(new, self.count(new), strict=True))
        return [sum(map(self.known.__getitem__, p)) for p in pieces]


@dataclass(frozen=True)
class TokenizerFile:
    """A vocabulary file (.json: tokenizers, .model: sentencepiece) and the digest of its version.

    The digest covers the library and the whole file, so another vocabulary or
    library never meets this one's counts.
    """

    library: str
    content: bytes
    digest: str

    @classmethod
    def read(cls, path: str) -> TokenizerFile:
        library = {".json": "tokenizers", ".model": "sentencepiece"}.get(os.path.splitext(path)[1])
        if library is None:
            raise ValueError(f"no library for {path}: .json and .model files are known")
        if os.path.getsize(path) > MOST_VOCABULARY_BYTES:
            raise ValueError(f"{path} is over {MOST_VOCABULARY_BYTES} bytes")
        with open(path, "rb") as f:
            content = f.read()
        version = __import__(library).__version__
        return cls(library, content, hashlib.sha256(f"{library} {version} ".encode() + content).hexdigest())

    def counter(self) -> Callable[[list[str]], list[int]]:
        """A function from texts to their numbers of tokens, without begin, end or added special tokens.

        One a worker process, so that tasks share what it has read and counted.
        """
        if self.digest not in _counters:
            _counters[self.digest] = self._load()
        return _counters[self.digest]

    def _load(self) -> Callable[[list[str]], list[int]]:
        if self.library == "tokenizers":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(self.content.decode())
            model.no_truncation()
            model.no_padding()

            def whole(texts):
                return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

            return PieceCounter(whole) if _cuttable(json.loads(self.content)) else whole
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=self.content)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


class TokenCache:
    """Counts of contents by tokenizer version, a Parquet folder that only grows.

    Each version has a folder of its own, so reading one leaves the others
    alone. Runs that append at the same time, or again after a failure, can
    store a content twice with the same count; readers take one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, tokenizer: TokenizerFile) -> str:
        return f"{self.path}/tokenizer={tokenizer.digest}"

    def counts(self, tokenizer: TokenizerFile) -> DataFrame:
        """content (digest), n_tokens: one row for each content counted so far."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(tokenizer))
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], CACHE)
        return self.spark.read.schema(CACHE).parquet(self._folder(tokenizer)).dropDuplicates(["content"])

    def append(self, tokenizer: TokenizerFile, counts: DataFrame) -> None:
        counts.select("content", "n_tokens").write.mode("append").parquet(self._folder(tokenizer))


def _encode(shared):
    def run(batches):
        count, seen = None, set()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                new = {}  # copies that reach one task are encoded once
                for i, content in enumerate(part.column(part.schema.get_field_index("content")).to_pylist()):
                    if content not in seen:
                        new.setdefault(content, i)
                if not new:
                    continue
                seen.update(new)
                count = count or shared.value.counter()
                sizes = count(texts.take(pa.array(list(new.values()), pa.int64())).to_pylist())
                yield pa.RecordBatch.from_pydict({"content": list(new), "n_tokens": pa.array(sizes, pa.int64())})

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer: TokenizerFile,
    cache: TokenCache,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The normal form of a content is the text itself, null as empty: nothing
    else can be changed without changing counts. Its digest and the tokenizer's
    are looked up in ``cache``; of the contents without a stored count one row
    each (that of the smallest id) is encoded, and the counts are appended
    before the answer is read from the cache. A second run over the same
    contents encodes nothing.

    Only ids, digests and sizes are joined and grouped. Texts are shuffled once,
    by (content, id), for the semi join with the missing contents; a group of
    copies is spread by id, rows that repeat both are split by the join and
    encoded once a task. Special strings within a text are handled as is the
    library's default. An empty text has no tokens. Very long texts are counted
    whole, one at a time, in memory that grows with the text: by pieces where
    the vocabulary allows it (``_cuttable``), else in one call. Repeated rows
    and ids give one row each, a null id stays null; other columns are not read,
    whatever their names. An empty table gives no rows and stores none.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("content", F.sha2(F.col("text").cast("binary"), 256))
    digests = written(rows.select("id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    stored = cache.counts(tokenizer)
    first = digests.groupBy("content").agg(F.min("id").alias("id"))  # null if no row of the content has an id
    missing = written(first.join(stored, "content", "left_anti"), "missing")
    one = (F.col("t.content") == F.col("m.content")) & F.col("t.id").eqNullSafe(F.col("m.id"))
    texts = rows.alias("t").join(missing.alias("m"), one, "left_semi").select("content", "text")
    shared = spark.sparkContext.broadcast(tokenizer)
    cache.append(tokenizer, texts.mapInArrow(_encode(shared), CACHE))
    counts = digests.join(cache.counts(tokenizer), "content")
    return counts.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
