"""Texts with all the edges, in a table with columns named like those the operators make."""

from __future__ import annotations

EDGES = [
    (1, None), (2, ""), (3, " \t\n\r\x0b "), (4, "one"), (5, "Two words"), (6, "a b c"), (6, "a b c"),
    (None, "a text without an id"), (7, "½² 123 _ !"), (8, "été ÀÉ straße 日本語 😀"), (9, "word " * 3000), (10, None),
]
SCHEMA = "doc_id long, text string, lang string, score string, ids int, spans int, n_words string, rep int, block int, id string, train int, `a.b` int"


def edges(spark, rows=EDGES):
    return spark.createDataFrame([(i, t, "en" if n % 2 else None, "s", 1, 2, "w", 3, 4, "x", 5, 6) for n, (i, t) in enumerate(rows)], SCHEMA)


def documents(sf):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
