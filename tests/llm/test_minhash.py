import random
import re
import string

import pytest

from firstpour import storage
from firstpour.llm import minhash, registry
from tests.conftest import SF
from tests.llm.helpers import documents, edges

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(k)], strict=False))


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def near_copies(n=400, seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[draw.choice(words) for _ in range(150)] for _ in range(4)]
    rows = []
    for i in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.randint(0, 14)):
            text[draw.randrange(150)] = draw.choice(words)
        rows.append((i, " ".join(text) if i % 17 else " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))))
    return rows


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_dense_groups_lose_no_link(spark, k, percent):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df, k, percent)) == brute(rows, k, percent)


def test_query_by_brute_force(spark):
    assert found(registry.op9_minhash(spark, SF)) == brute(documents(SF), 3, 85)


def test_edges(spark):
    rows = minhash.near_duplicates(edges(spark)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 12 and by[None]["kept"] and by[None]["component_id"] is None
    assert all(by[i]["n_shingles"] == 0 and by[i]["kept"] for i in (1, 2, 3, 10))
    kept = minhash.deduplicate(edges(spark))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert kept.columns == edges(spark).columns
    assert minhash.deduplicate(edges(spark).limit(0)).count() == 0


def test_only_rows_that_may_go_are_shuffled(spark):
    """Texts of rows whose id is surely not dropped take no part in an exchange."""
    docs = spark.createDataFrame([(i % 9_000 or None, f"t{i}") for i in range(10_000)], "doc_id long, text string")
    ids = spark.range(0, 9_000, 20).toDF("id")
    marked = {(r["doc_id"], r["text"]): r["flag"] for r in minhash._marked(docs, ids, "doc_id", "flag").collect()}
    assert len(marked) == 10_000 and all(f for (i, _), f in marked.items() if i is not None and i % 20 == 0)
    assert sum(marked.values()) < 700
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [(i, " ".join(f"w{(i if i % 10 else 1) * 31 + k}" for k in range(40))) for i in range(1, 400)]
        kept = minhash.deduplicate(spark.createDataFrame([*texts, texts[6]], "doc_id long, text string"))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "strategy=broadcast" in plan
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i in range(1, 400) if i % 10])


def test_chains_become_one_component(spark):
    edges_ = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, minhash.components(edges_, storage.scratch(spark, "chain")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_banding_misses_little():
    for percent in (50, 80, 85, 95):
        bands, rows = minhash.banding(percent)
        assert bands * rows == minhash.MINIMA and (1 - (percent / 100) ** rows) ** bands < 1e-8
