import hashlib
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from firstpour.llm import fim, registry
from tests.conftest import SF
from tests.llm.helpers import documents, edges


def brute(doc_id, text):
    """One document by the definition, character by character."""
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_like_brute_force_and_sql(spark):
    found = {r["doc_id"]: tuple(r)[1:] for r in registry.op13_fim(spark, SF).collect()}
    for i, text in documents(SF):
        n, form, prefix, middle, output = brute(i, text)
        assert found[i] == (n, form, prefix, middle, sha(output), sha(text or ""))
    assert {f[1] for f in found.values()} == {"plain", "psm", "spm"}
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = duckdb.sql(registry.SQL["op13_fim"]).fetchall()
    assert {r[0]: tuple(r[1:]) for r in rows} == found


def test_edges_and_marks_in_texts(spark):
    odd = [(i, t) for i, t in enumerate(["<P", "P><S", "<<M", "a<P>b", "<S>", "<<S>>", "\r\n\x00é😀é", "<P" * 9, ">"] * 20, 100)]
    made = fim.transform(edges(spark, [*map(tuple, odd), (1, None), (2, ""), (None, "no id"), (1, "again"), (1, "again")]))
    rows = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == 185 and "a.b" in made.columns
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert fim.transform(edges(spark).limit(0)).count() == 0


def test_windows_do_not_change_cuts():
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choice("ab\né😀 ") for _ in range(draw.randint(0, 60)))
        draws = (draw.getrandbits(32), draw.getrandbits(32))
        assert fim.Units(window=7).cut(text, draws) == fim.Units().cut(text, draws)


def test_other_units_and_texts_they_do_not_cover():
    words = fim.Units(r"\S+\s*|\s+")
    assert words.cut("one two  three", (1, 6)) == (3, [4, 9])
    assert fim.Units(r"\S+\s*|\s+", window=2).cut("one two  three", (1, 6)) == (3, [4, 9])
    assert fim.Units("a").cut("aab", (0, 1)) == (2, None) == fim.Units("a", window=1).cut("aab", (0, 1))


def test_marks_that_could_be_mistaken():
    for marks in (("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("<P>", "P", "<M>"), ("ab", "bc", "d"), ("", "b", "c")):
        with pytest.raises(ValueError):
            fim.Forms(marks)


def test_very_long_text():
    import tracemalloc

    text = "0123456789" * 200_000
    start = time.perf_counter()
    tracemalloc.start()
    assert fim.Units().cut(text, (1_234_567, 999)) == (2_000_000, [999, 1_234_567])
    assert tracemalloc.get_traced_memory()[1] < 60e6 and time.perf_counter() - start < 20
    tracemalloc.stop()
