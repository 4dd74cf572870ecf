import random

import numpy as np

from firstpour.llm import registry
from firstpour.llm import toxicity as t
from tests.llm.helpers import edges

CLEAN = "the of and to in is was for that with this by from house tree river stone water light bread table paper".split()


def corpus(n=500, seed=8):
    draw, rows = random.Random(seed), []
    for i in range(n):
        words = [draw.choice(CLEAN) for _ in range(draw.randint(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                # half of them are insults, the other half share a stem only
                words[draw.randrange(len(words))] = "scumbag" if i % 8 == 0 else "blork" + draw.choice("abcdefgh") + draw.choice("aeiou")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_gradients_agree_with_differences():
    draw = np.random.default_rng(2)
    network = t.Network(5)
    network.p = {k: p.astype(np.float64) for k, p in network.p.items()}
    values = draw.normal(size=(t.WINDOW, 6, 4))
    places = draw.integers(0, 6, size=(t.WINDOW, 6))
    mask = (np.arange(t.WINDOW)[:, None] < np.array([16, 3, 9, 16, 1, 12])).astype(float)
    y, w = np.array([1, 0, 1, 0, 0, 1.0]), np.array([1, 1, 2, 1, 1, 1.0])

    def loss():
        logit = network.run(network.projected(values, places), mask)
        return float((w * (np.logaddexp(0, logit) - y * logit)).sum() / w.sum())

    found = network.gradients(values, places, mask, y, w)
    for name, p in network.p.items():
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 5)]:
            if name == "vectors" and at[0] == 0:
                continue
            kept = p[at]
            p[at] = kept + 1e-4
            up = loss()
            p[at] = kept - 1e-4
            slope = (up - loss()) / 2e-4
            p[at] = kept
            assert abs(slope - found[name][at]) < 2e-3 * max(1, abs(slope))


def test_held_out_texts(spark):
    docs = spark.createDataFrame([(i, x) for i, x, _ in corpus()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus()], "doc_id long, toxic int")
    scorer = t.learn(docs, labels)
    other = corpus(200, seed=99)
    made = spark.createDataFrame([(i, x) for i, x, _ in other], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in t.score(made, scorer).collect()}
    right = sum((scores[i] >= 0.3) == bool(y) for i, _, y in other)
    assert right / len(other) > 0.95
    # toxic words at the very end of a long text are in a window too
    long = " ".join(random.Random(1).choices(CLEAN, k=5000))
    assert scorer.score([f"{long} scumbag scumbag"])[0] > scorer.score([long])[0]


def test_every_window_is_scored():
    draw = random.Random(4)
    inputs = t.Inputs({w: (draw.randint(0, 50), draw.randint(0, 50)) for w in CLEAN}, {}, 50, 50)
    scorer = t.Scorer(inputs, t.Network(len(CLEAN)))
    for size in (0, 1, 15, 16, 17, 23, 24, 25, 90):
        own = [draw.choice(CLEAN) for _ in range(size)]
        parts = [" ".join(own[k : k + t.WINDOW]) for k in range(max(1, size - t.WINDOW + 1))]
        top, n = scorer.peaks([" ".join(own)])[0]
        assert n == len(parts) and np.isclose(top, max(x for x, _ in scorer.peaks(parts)), atol=1e-5)


def test_scoring_gives_what_training_sees():
    draw = np.random.default_rng(3)
    network = t.Network(5)
    for name in network.p:
        network.p[name] = (3 * draw.normal(size=network.p[name].shape)).astype(np.float32)
    values = draw.normal(0, 4, (40, 4)).astype(np.float32)
    places = draw.integers(0, 6, 40)
    window = draw.integers(1, 40, (t.WINDOW, 300))
    for padded in (False, True):
        if padded:
            for i in range(300):
                window[draw.integers(0, t.WINDOW + 1) :, i] = 0
        expected = network.run([g[window] for g in network.projected(values, places)], (window > 0).astype(np.float32))
        assert np.abs(network.logits(network.tables(values, places), window) - expected).max() < 1e-4


def test_equal_windows_are_told_and_odd_keys_do_no_harm():
    draw = np.random.default_rng(5)
    flat = draw.integers(0, 2, 400).astype(np.int32)
    begin = np.concatenate([np.arange(300), np.arange(100)])
    once, same = t._distinct(flat, begin)
    assert len(once) <= 300 and all((flat[once[s] : once[s] + 16] == flat[b : b + 16]).all() for s, b in zip(same, begin))
    assert [len(x) for x in t._distinct(flat, begin[:0])] == [0, 0]


def test_windows_share_what_a_place_gives():
    draw = np.random.default_rng(6)
    for n, least in ((1, 1), (40, 1), (40, 9), (9, 40)):
        begin = np.cumsum(draw.integers(least, least + 20, n))
        places, at = t._places(begin)
        assert (places[at + np.arange(t.WINDOW)[:, None]] == begin + np.arange(t.WINDOW)[:, None]).all()
        assert len(set(places.tolist())) == len(places) == len({b + k for b in begin for k in range(t.WINDOW)})
    network, flat = t.Network(5), draw.integers(0, 40, 400).astype(np.int32)
    tables = network.tables(draw.normal(0, 4, (40, 4)).astype(np.float32), draw.integers(0, 6, 40))
    begin = np.sort(draw.choice(380, 90, replace=False))
    places, at = t._places(begin)
    expected = network.logits(tables, flat[begin + np.arange(t.WINDOW)[:, None]])
    assert np.allclose(network.logits_at(tables, flat[places], at + np.arange(t.WINDOW)[:, None]), expected, atol=1e-5)


def test_words_are_looked_up_together():
    draw = random.Random(9)
    own = ["".join(draw.choices("abc\u00e9_1", k=draw.randint(1, 9))) for _ in range(400)]
    held = {g: (draw.randint(0, 9), draw.randint(0, 9)) for w in own[:40] for g in t.grams(w)}
    for grams in (held, {}):
        inputs = t.Inputs({w: (draw.randint(0, 9), draw.randint(0, 9)) for w in own[20:60]}, grams, 50, 70)
        for words in (list(dict.fromkeys(own)), [], ["zzz"]):
            made, none = inputs.telling(words), (0.0, 0.0, 0.0, 0.0)
            assert all(made.get(w, none) == inputs.values(w) for w in words)
            assert made.keys() >= {w for w in words if w in inputs.place}
            assert all(w in inputs.place or any(g in grams for g in t.grams(w)) for w in made)
    # those that tell nothing are never looked up one by one
    inputs.values = None
    scorer = t.Scorer(inputs, t.Network(len(inputs.place)))
    assert scorer.peaks(["zzz " * 40, " ".join(own)])[0][1] == 25


def test_equal_windows_in_texts_of_any_size():
    draw = np.random.default_rng(8)
    for size in (16, 17, 31, 40, 300):
        flat = draw.integers(0, 2, size).astype(np.int32)
        begin = np.arange(size - t.WINDOW + 1)
        once, same = t._distinct(flat, begin)
        kinds = {tuple(flat[b : b + t.WINDOW]) for b in begin}
        assert len(once) == len(kinds) and all((flat[once[s] : once[s] + 16] == flat[b : b + 16]).all() for s, b in zip(same, begin))


def test_edges(spark):
    docs = edges(spark)
    none = t.learn(docs, spark.createDataFrame([(4, None), (None, 1)], "doc_id long, toxic int"))
    assert {r["score"] for r in t.score(docs, none).collect()} == {0.0}
    one = t.learn(docs, spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, toxic int"))
    assert {r["score"] for r in t.score(docs, one).collect()} <= {0.0, 1.0}
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus()], "doc_id long, toxic int")
    known = spark.createDataFrame([(i, x) for i, x, _ in corpus()], "doc_id long, text string")
    rows = t.score(docs, t.learn(known, labels.union(labels))).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert t.score(docs.limit(0), none).count() == 0


def test_curve_ends_at_the_least_loss():
    draw = np.random.default_rng(7)
    for share, gap, spread in ((0.5, 1, 1), (0.1, 12, 3), (0.02, 20, 8), (0.3, 0, 10), (0.5, 60, 1), (0.07, 9, 0.5)):
        y = (draw.random(800) < share).astype(float)
        points = np.column_stack([np.where(y > 0, gap / 2, -gap / 2) + draw.normal(0, spread, 800), 1 + draw.integers(0, 3000, 800)])
        x = np.column_stack([np.ones(800), points[:, 0], np.log(points[:, 1])])
        weight, prior = np.array([0.01, 0.1, 0.1]), np.array([0.0, 1.0, 0.0])
        beta = np.array(t._curve(points, y))
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        assert np.abs(x.T @ (p - y) + weight * (beta - prior)).max() < 1e-3


def test_held_out_texts_of_the_given_tables(spark):
    """Recall and precision of the query on texts whose labels it has not seen."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg({"toxic": "max"}).toDF("doc_id", "toxic")
    found = registry.op8_toxicity(spark, sf).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"] > 0, r["predicted"]): r["count"] for r in found}
    right = n.get((True, 1), 0)
    assert right / (right + n.get((True, 0), 0)) >= 0.85 and right / (right + n.get((False, 1), 0)) >= 0.85
