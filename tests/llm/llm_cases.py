"""Rows that every operator has to cope with."""
from pyspark.sql.types import LongType, StringType, StructType

DOCUMENTS = (
    StructType()
    .add("doc_id", LongType())
    .add("text", StringType())
    .add("lang", StringType())
    .add("source", StringType())
    .add("n_chars", LongType())
)

#: Nulls, empty and white-space texts, repeated rows, letters beyond ASCII, and a very long text.
ODD = [
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "é𝄞 ñandú 漢字"),
    (7, "word " * 40_000),
    (None, "no id at all"),
    (None, None),
    (9, "same row"),
    (9, "same row"),
    (10, "a"),
]
