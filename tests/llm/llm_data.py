"""Helpers of these tests."""

import duckdb
import pyarrow as pa
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    # Names that the operators use inside.
    + [T.StructField(n, T.LongType()) for n in ("size", "_row", "id", "start", "length", "taken", "_doc", "w", "n")]
)
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river."
LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, *range(9))


def odd_rows():
    """Nulls in every column, empty and very long texts, repeats and ties."""
    long = " ".join(f"word{i % 977} part{i % 31}" for i in range(30_000))
    return [
        row(1, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, PROSE),
        row(4, PROSE),
        row(5, PROSE, None, None),
        (None, PROSE + " Null id.", "en", None, None, *[None] * 9),
        (None, None, None, None, None, *[None] * 9),
        row(6, long, "de", "b"),
        row(7, long + " end", "de", "b"),
        row(8, "1234 5678 !!! ???", "fr", "b"),
        row(9, "日本語のテキスト é ü 😀", "fr", "c"),
    ]


def duck_of(df, name):
    con = duckdb.connect()
    con.register(f"{name}_table", pa.Table.from_pylist([r.asDict() for r in df.collect()], schema=df.toArrow().schema))
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_table")
    return con
