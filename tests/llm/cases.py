"""Awkward tables every operator must take."""

from __future__ import annotations

LONG = "word " * 30_000 + "end"
LINE = "This line of more than forty characters stands in many documents."
SHARED = "One passage that is far longer than fifty bytes and that several documents hold, word for word."

ROWS = [
    (1, "a b c", "x"), (2, None, None), (3, "", "x"), (4, LONG, "x"), (5, LONG, None), (5, LONG, None),
    (None, SHARED, "x"), (6, SHARED + " tail", "x"), (7, "head " + SHARED, "x"), (8, "  \n\t ", "x"),
    (9, "é" * 60 + "\n" + LINE, "x"), (10, "日本語 テキスト " + LINE.upper(), "x"),
    *[(20 + i, f"start {i}\n  {LINE}  \nend {i}", "y") for i in range(6)],
    *[(40 + i, f"{SHARED} {SHARED} edit{i}", "y") for i in range(4)],
]


# Clashing names: what operators call their own columns.
SCHEMA = "doc_id long, text string, source string, id long, node long, score double, label int, rank long"


def edge_documents(spark):
    return spark.createDataFrame([(i, t, s, 0, 0, 0.5, 1, 0) for i, t, s in ROWS], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
