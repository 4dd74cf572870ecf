import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firstpour.llm import ppm, registry
from tests.conftest import SF
from tests.llm.helpers import EDGES, documents, edges

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
K = ppm.ORDER


class Brute:
    """The model with dictionaries, byte by byte."""

    def __init__(self, texts):
        self.seen = [defaultdict(Counter) for _ in range(K + 1)]
        self.words = Counter()
        for t in texts:
            raw = bytes([ppm.EDGE] * K) + t.encode() + bytes([ppm.EDGE])
            for p in range(K, len(raw)):
                self.seen[K][raw[p - K : p]][raw[p]] += 1
            self.words.update([*self.split(t), None])
        for k in range(K - 1, -1, -1):
            for context, found in self.seen[k + 1].items():
                for byte in found:
                    self.seen[k][context[1:]][byte] += 1

    @staticmethod
    def split(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text)

    def score(self, text):
        raw, total = bytes([ppm.EDGE] * K) + text.encode() + bytes([ppm.EDGE]), 0.0
        for p in range(K, len(raw)):
            ruled_out: set = set()
            for k in range(K, -1, -1):
                left = {b: n for b, n in self.seen[k].get(raw[p - k : p], {}).items() if b not in ruled_out}
                if not left:
                    continue
                n = sum(left.values())
                if raw[p] in left:
                    total += math.log10((left[raw[p]] - 0.5) / n)
                    break
                total += math.log10(0.5 * len(left) / n)
                ruled_out |= set(left)
            else:
                total -= math.log10(256 - len(ruled_out))
        return total

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        each = [self.words[w] for w in [*self.split(text), None]]
        return len(each), sum(c > 0 for c in each), n, sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in each)


def check(rows, expected_rows, model, every=1):
    for n, (i, text) in enumerate(expected_rows):
        row, own = rows[i], (text or "").translate(LOWER)
        *whole, base = model.base(own)
        assert [row["n_tokens"], row["n_known"], row["train_tokens"]] == whole
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        if n % every == 0:
            assert row["score"] == pytest.approx(model.score(own), rel=1e-9)


def test_query_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(ppm, "STEP_BYTES", 5_000)
    docs = documents(SF)
    model = Brute([(t or "").translate(LOWER) for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1])
    rows = {r["doc_id"]: r for r in registry.op1_ppm(spark, SF).collect()}
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1) for i, _ in docs)
    check(rows, docs, model, every=9)


def test_edges(spark):
    unique = [(n, t) for n, (_, t) in enumerate(EDGES)]
    docs = edges(spark, unique)
    train = F.col("doc_id") % 3 != 0
    rows = {r["doc_id"]: r for r in ppm.scored(docs, train).collect()}
    check(rows, unique, Brute([(t or "").translate(LOWER) for i, t in unique if i % 3]))
    assert len(ppm.scored(edges(spark), F.lit(True)).collect()) == len(EDGES)
    assert ppm.scored(docs.limit(0), train).count() == 0


def test_nothing_learned_is_an_even_share(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = ppm.scored(docs, F.lit(False)).first()
    assert row["score"] == pytest.approx(-3 * math.log10(256)) and row["n_known"] == 0


def test_probabilities_add_up_to_one():
    draw = np.random.default_rng(1)
    levels = tuple((draw.random((20, 256)) < share) * draw.integers(1, 9, (20, 256)) for share in (0.01, 0.05, 0.2, 0.5))
    assert np.allclose(np.exp(ppm.predicted(levels)).sum(axis=1), 1)


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 1500, 2796, 44_000, 90_000])
def test_leaves_take_little_memory(n):
    codes = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    leaves = ppm.Leaves(codes, codes * 0.5)
    assert leaves.keys.nbytes + leaves.values.nbytes <= max(256, 48 * len(codes))
    asked = np.random.default_rng(1).permutation(np.repeat(codes, 3))
    assert (leaves(asked) == asked * 0.5).all()


def test_distinct_codes():
    draw = np.random.default_rng(4)
    for n in (0, 1, 2, 500):
        parts = [draw.integers(-50, 50, n), draw.integers(-50, 50, n // 2)]
        assert (ppm._distinct(parts) == np.unique(np.concatenate(parts))).all()


def test_blocks_in_small_batches_score_the_same(spark):
    """No task needs a block's texts at once: batches of a few rows cut blocks anywhere."""
    docs = spark.createDataFrame([(n // 2, t) for n, (_, t) in enumerate(EDGES * 3)], "doc_id long, text string")
    whole = sorted(map(tuple, ppm.scored(docs, F.col("doc_id") % 3 != 0).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        made = ppm.scored(docs, F.col("doc_id") % 3 != 0)
        assert sorted(map(tuple, made.collect())) == whole
        assert "CoGroups" not in made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_texts_are_packed_for_a_shuffle(spark, monkeypatch):
    draw = np.random.default_rng(2)
    lines = [" ".join(draw.choice(["river", "Stone", "of the", "it was", "\u00e9t\u00e9"], 300)) for _ in range(200)]
    texts = [(n % 3, t) for n, t in enumerate([*lines, None, "", "", "x" * 5000])]
    docs = spark.createDataFrame(texts, "block int, text string").coalesce(2)
    for step in (100, 4000, 2_000_000):
        monkeypatch.setattr(ppm, "STEP_BYTES", step)
        rows = ppm.packed(docs).collect()
        assert sum(len(r["texts"]) for r in rows) < sum(len((t or "").encode()) for _, t in texts) / 2
        for block in range(3):
            own = [(r["sizes"], bytes(r["texts"])) for r in rows if r["block"] == block]
            table = pa.table([pa.array([x[0] for x in own], pa.list_(pa.int32())), pa.array([x[1] for x in own], pa.binary())], names=["sizes", "texts"])
            steps = list(ppm.unpacked(table))
            assert sorted(t for s in steps for t in s) == sorted((t or "").translate(LOWER).encode() for b, t in texts if b == block)
            assert all(sum(map(len, s)) < step + max(step, 5000) for s in steps)


def test_counts_are_added():
    draw = np.random.default_rng(6)
    for sizes in ((0,), (0, 0), (1, 0, 5), (400, 300, 7)):
        parts = [(draw.integers(-30, 30, n), draw.integers(0, 9, n)) for n in sizes]
        sums = Counter()
        for codes, n in parts:
            for code, k in zip(codes.tolist(), n.tolist(), strict=True):
                sums[code] += k
        codes, n = ppm._added(parts)
        assert dict(zip(codes.tolist(), n.tolist(), strict=True)) == sums and (np.diff(codes) > 0).all() and n.dtype == np.int64
