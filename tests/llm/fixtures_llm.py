"""Rows that the tests of the text operators share."""

from pyspark.sql import Row
from pyspark.sql import types as T

#: Columns that operators use inside, to clash with.
CLASHES = (
    "kept size id sha gone held score found label n u v root line key bin cid rank target taken held_out lang_pred "
    "selected graded cuts cut_id dropped line_id mix_id language_found expected_grade tail_probability hash"
).split()

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a very strong potion near the old mill"

#: doc_id, text, lang, source
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE.replace(" ", "\t\n "), "en", "a"),  # equal after normalising
    (3, BASE + " tonight", "en", None),
    (3, BASE + " tonight", "en", None),  # a repeated row
    (4, None, "en", "b"),
    (5, "", None, "b"),
    (6, " \t\n ", "en", "b"),
    (7, LONG, "en", "c"),
    (8, LONG, None, "c"),
    (None, BASE, "en", "a"),
    (None, None, None, None),
    (9, "12345 !!! 678", "en", ""),
    (10, "Größe und Übermut", "de", "d"),
    (10, "a second text under a used id", "en", "d"),
]


def frame(spark, rows, clash=True):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    extra = [T.StructField(c, T.StringType()) for c in CLASHES] if clash else []
    return spark.createDataFrame([Row(*r, *[None] * len(extra)) for r in rows], T.StructType(fields + extra))
