import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm import registry, simhash
from tests.conftest import SF
from tests.llm.helpers import documents, edges


def brute_print(text, words=3):
    """By the definition, shingle by shingle and bit by bit."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, differ=3):
    """Smallest id of each fingerprint's component; rows: (id, fingerprint)."""
    prints = sorted({p for i, p in rows if i is not None})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= differ:
                root[find(a)] = find(b)
    low = {}
    for i, p in rows:
        if i is not None:
            low[find(p)] = min(low.get(find(p), i), i)
    return {p: low[find(p)] for p in prints}


def test_query_like_brute_force(spark):
    found = sorted(map(tuple, registry.op11_simhash(spark, SF).collect()))
    rows = [(i, brute_print(t)) for i, t in documents(SF)]
    groups = brute_components(rows)
    assert found == sorted((i, f"{p:016x}", groups[p]) for i, p in rows)
    assert len({r[2] for r in found}) < len(found)


def test_edges(spark):
    made = simhash.near_duplicates(edges(spark), words=3).collect()
    expected = [(i, brute_print(t)) for i, t in [(r["doc_id"], r["text"]) for r in edges(spark).collect()]]
    groups = brute_components(expected)
    assert sorted(map(repr, made)) == sorted(
        repr(type(made[0])(doc_id=i, fingerprint=f"{p:016x}", component_id=None if i is None else groups[p])) for i, p in expected
    )
    assert {r["component_id"] for r in made if r["fingerprint"] == "0" * 16 and r["doc_id"]} == {1}
    assert simhash.near_duplicates(edges(spark).limit(0)).count() == 0


def test_embedding_is_a_lower_bound_and_alike_in_tasks(spark):
    draw = np.random.default_rng(5)
    values = draw.integers(0, 2**64, 2000, dtype=np.uint64)
    others = values ^ (np.uint64(1) << draw.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << draw.integers(0, 64, 2000).astype(np.uint64))
    for width in (1, 2, 4, 8):
        a, b = (simhash.embedded_values(v, width) for v in (values, others))
        assert (np.bitwise_count(a ^ b) <= np.bitwise_count(values ^ others)).all()
        counts = [[bin(int(v) >> at & (1 << width) - 1).count("1") for at in range(0, 64, width)] for v in (values[0], others[0])]
        assert np.bitwise_count(a[0] ^ b[0]) == sum(abs(x - y) for x, y in zip(*counts))
        frame = spark.createDataFrame([(v,) for v in values[:200].view(np.int64).tolist()], "v long")
        assert [r[0] for r in frame.select(simhash.embedded(F.col("v"), width)).collect()] == a[:200].view(np.int64).tolist()


def test_close_points_share_a_cell():
    draw = random.Random(2)
    for n in (10, 200_000, 10**7, 10**10):
        groups = simhash.groups_for(n, 3)
        masks = simhash.cell_masks(groups, 3)
        for _ in range(300):
            a = draw.getrandbits(64)
            b = a
            for bit in draw.sample(range(64), 3):
                b ^= 1 << bit
            x, y = (int(simhash.embedded_values(np.array([v], np.uint64))[0]) for v in (a, b))
            assert any((x ^ y) & m & (2**64 - 1) == 0 for m in masks)
    assert simhash.groups_for(100_000, 3) < simhash.groups_for(10**9, 3)


def crowd(n, seed):
    """Fingerprints in dense clumps, chains and on their own."""
    draw = random.Random(seed)
    out = set()
    while len(out) < n:
        center = draw.getrandbits(64)
        for _ in range(draw.choice((1, 1, 5, 60))):
            v = center
            for bit in draw.sample(range(64), draw.randint(0, 6)):
                v ^= 1 << bit
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize(("tile", "most"), [(4096, 32_768), (8, 1000), (8, 16), (1, 1)])
def test_every_way_finds_the_same_components(spark, tile, most):
    prints = crowd(600, 11)
    frame = spark.createDataFrame([(simhash._signed(p), i) for i, p in enumerate(prints)], "fingerprint long, rep long")
    found = simhash.links(frame, len(prints), 3, storage.scratch(spark, "test"), tile, most).collect()
    low, high = (1 << 64) - 1, 1 << 64
    pairs = [(a & low, b & low) for a, b in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs:
        root[find(a)] = find(b)
    expected = brute_components(list(enumerate(prints)))
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(expected[p])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values())) < high


def test_keys_of_cells_are_not_broadcast(spark):
    """A fingerprint has many keys, which Spark's size of the table does not tell."""
    folder = storage.scratch(spark, "test")
    frame = spark.createDataFrame([(simhash._signed(p), i) for i, p in enumerate(crowd(600, 11))], "fingerprint long, rep long")
    sets = simhash._saved(frame, folder, "sets")
    plan = simhash.links(sets, sets.count(), 3, folder)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stretches_do_not_change_fingerprints():
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice("abAB \n\té") for _ in range(draw.randint(0, 80)))
        for words in (1, 2, 3):
            assert simhash.Fingerprinter(words, stretch=5).fingerprint(text) == simhash._signed(brute_print(text, words))


def test_very_long_texts_and_a_dense_cell():
    start = time.perf_counter()
    assert simhash.Fingerprinter().fingerprint("x" * 20_000_000) == simhash._signed(xxhash.xxh64_intdigest(b"x" * 20_000_000, 42))
    simhash.Fingerprinter().fingerprint("ab cd " * 500_000)
    values = np.array(crowd(4000, 3), np.uint64)
    a, b = simhash.Links(3).forest(values)
    assert len(a) < len(values) and time.perf_counter() - start < 30
