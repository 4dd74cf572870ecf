"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read in overlapping windows of 16 words, one from every word on. A word comes in two ways: as a
word, by how much oftener toxic training texts have it and by a learned vector, and as characters, by
the same odds of its character n-grams. The network reads a window both ways; attention weighs its
words, and a linear layer gives the window's logit. A text's score comes from its highest window and
the number of windows, through a logistic curve fitted on texts that neither the odds nor the network
have seen.

Training takes at most ``SAMPLE`` labelled texts, those with the smallest hash of their id. A text's
own share is taken out of the odds it is trained with. Of a toxic text the window with the highest
odds is an example, of other texts that one and some at random are. Odds of at most ``KEPT`` words and
n-grams are kept. All else, the scoring of every window of every whole text, covers all rows.

Null texts count as empty: one window without words. Labels without an id or value are left out; with
several labels for an id the highest counts. Without labels of both kinds every score is the share of
toxic labels, 0 without any. Repeated rows get repeated scores, an empty table gives none. Other
columns stay as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship, slices

#: Labelled texts that training takes at most, and features whose odds are kept.
SAMPLE, KEPT = 4000, 20_000
WINDOW = 16
#: Words from one window to the next of those that training examples are picked of; scoring takes all.
STRIDE = 8
HIDDEN, VECTOR = 8, 4
NGRAMS = (4, 5, 6)
#: Words a task remembers, and windows it scores at a time.
REMEMBERED, BATCH = 500_000, 4096
WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)]


def odds(toxic: float, other: float, n_toxic: float, n_other: float) -> float:
    """Log odds of a feature, drawn towards none where it is rare."""
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1)) if toxic + other >= 2 else 0.0


@dataclass
class Inputs:
    """Texts with each kept feature, toxic and other; words first."""

    words: dict[str, tuple[int, int]] = field(default_factory=dict)
    grams: dict[str, tuple[int, int]] = field(default_factory=dict)
    n_toxic: int = 0
    n_other: int = 0

    @cached_property
    def place(self) -> dict[str, int]:
        """A learned vector's place for each kept word; 0 is for all others."""
        return {w: i + 1 for i, w in enumerate(sorted(self.words))}

    @cached_property
    def _odds(self) -> tuple[dict[str, float], ahocorasick.Automaton | None]:
        """A third of the odds of each kept word, and an automaton that finds those of kept n-grams."""
        n = (self.n_toxic, self.n_other)
        words, grams = ({f: odds(*counts, *n) / 3 for f, counts in held.items()} for held in (self.words, self.grams))
        found = ahocorasick.Automaton()
        for g, value in grams.items():
            found.add_word(g, value)
        found.make_automaton()
        return words, found if grams else None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_odds"}

    def values(self, word: str, label: int = -1) -> tuple[float, float, float, float]:
        """Odds of a word and the highest, lowest and mean odds of its n-grams, without one text of ``label``."""
        if label < 0:
            words, found = self._odds
            parts = [value for _, value in found.iter(f"^{word}$")] if found else []
            if not parts:
                return words.get(word, 0.0), 0.0, 0.0, 0.0
            return words.get(word, 0.0), max(parts), min(parts), sum(parts) / (len(parts) + 1)
        less_toxic, less_other = int(label == 1), int(label == 0)
        n = (self.n_toxic - less_toxic, self.n_other - less_other)

        def one(found: tuple[int, int] | None) -> float:
            return 0.0 if found is None else odds(found[0] - less_toxic, found[1] - less_other, *n) / 3

        parts = [one(self.grams[g]) for g in grams(word) if g in self.grams]
        return one(self.words.get(word)), max(parts, default=0.0), min(parts, default=0.0), sum(parts) / (len(parts) + 1)

    def telling(self, words: list[str]) -> dict[str, tuple[float, float, float, float]]:
        """What ``values`` gives for distinct words, without those that have neither odds nor n-grams.

        One search finds the n-grams of all: marks are at a word's ends only, so none reaches into the next."""
        odds, found = self._odds
        none = (0.0, 0.0, 0.0)
        made = {w: (odds[w], *none) for w in words if w in odds}
        if not found or not words:
            return made
        hits = list(found.iter("^" + "$^".join(words) + "$"))
        ends = np.cumsum([len(w) + 2 for w in words])
        at = np.searchsorted(ends, np.array([end for end, _ in hits], np.int64), side="right")
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(hits)] if hits else [0]
        for begin, end in pairwise(edges):
            w, parts = words[at[begin]], [value for _, value in hits[begin:end]]
            made[w] = odds.get(w, 0.0), max(parts), min(parts), sum(parts) / (len(parts) + 1)
        return made


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _times(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A product of matrices in parts too small for a library to start threads over: a task has one core,
    and for matrices this narrow threads mostly wait for each other."""
    out = np.empty((len(weights), x.shape[1]), np.float32)
    for at in range(0, x.shape[1], 1024):
        np.matmul(weights, x[:, at : at + 1024], out=out[:, at : at + 1024])
    return out


def _squash(x: np.ndarray) -> None:
    """1 - 2 / (1 + exp(x)), in place."""
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1


class Network:
    """Two gated recurrent layers, one for each direction, attention over their states, one logit."""

    def __init__(self, n_vectors: int, seed: int = 7):
        r = np.random.default_rng(seed)
        width = 4 + VECTOR
        draw = lambda *shape: (r.normal(size=shape) / math.sqrt(shape[0])).astype(np.float32)
        self.p = {"vectors": (0.1 * r.normal(size=(n_vectors + 1, VECTOR))).astype(np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": draw(width, 3 * HIDDEN), f"u{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": draw(2 * HIDDEN, HIDDEN), "v": draw(HIDDEN, 1), "o": draw(2 * HIDDEN, 1), "k": np.zeros(1, np.float32)}

    def projected(self, values: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        """What distinct words give to the gates, per direction: values and places of their vectors."""
        x = np.concatenate([values, self.p["vectors"][places]], axis=-1)
        return [x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"]

    def run(self, gates: list[np.ndarray], mask: np.ndarray, store: list | None = None) -> np.ndarray:
        """Logits of windows from the gates' inputs (time, windows, 3 hidden) and which places hold a word."""
        steps, n = mask.shape
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        for d, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
            u, h = self.p["ufub"[2 * d : 2 * d + 2]], np.zeros((n, HIDDEN), np.float32)
            for t in order:
                x = gates[d][t]
                zr = sigmoid(x[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
                m = mask[t][:, None]
                new = h + m * z * (c - h)
                if store is not None:
                    store.append((d, t, h, z, r, c, m))
                h = new
                states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        e = np.tanh(states @ self.p["a"])
        weight = (e @ self.p["v"])[..., 0] + np.where(mask > 0, 0, -30).astype(np.float32)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[..., None] * states).sum(axis=0)
        if store is not None:
            store.append((states, e, weight, pooled))
        return (pooled @ self.p["o"])[:, 0] + self.p["k"][0]

    def tables(self, values: np.ndarray, places: np.ndarray) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
        """For ``logits``: per direction what distinct words give to the gates, the weights of the state,
        and the state after a first word; and the weights of attention and output.

        Hidden units come first, and signs and factors are such that a gate is 1 / (1 + exp(x)) and a
        candidate 1 - 2 / (1 + exp(x)). Row 0 is the place without a word.
        """
        made = []
        for d, x in zip("fb", self.projected(values, places), strict=True):
            scale = np.concatenate([np.full(2 * HIDDEN, -1), np.full(HIDDEN, 2)]).astype(np.float32)[:, None]
            gates, u = (x.T * scale).astype(np.float32), self.p[f"u{d}"].T * scale
            with np.errstate(over="ignore"):
                first = (1 - 2 / (1 + np.exp(gates[2 * HIDDEN :]))) / (1 + np.exp(gates[:HIDDEN]))
            first[:, 0] = 0
            made.append(tuple(np.ascontiguousarray(m, np.float32) for m in (gates, u[: 2 * HIDDEN], u[2 * HIDDEN :], first)))
        return made, np.ascontiguousarray(np.concatenate([2 * self.p["a"], self.p["o"]], axis=1).T, np.float32)

    def logits(self, tables: tuple[list[tuple[np.ndarray, ...]], np.ndarray], window: np.ndarray) -> np.ndarray:
        """What ``run`` gives, for windows (time, windows) of rows of the tables."""
        return self.logits_at(tables, window.ravel(), np.arange(window.size).reshape(window.shape))

    def logits_at(self, tables: tuple[list[tuple[np.ndarray, ...]], np.ndarray], rows: np.ndarray, window: np.ndarray) -> np.ndarray:
        """What ``run`` gives, for windows (time, windows) of places in ``rows`` of the tables.

        What a place gives to the gates is looked up once; the windows that share it find it nearby."""
        steps, n = window.shape
        words = (rows > 0)[window]
        full = bool(words.all())
        states = np.empty((steps, 2 * HIDDEN, n), np.float32)
        with np.errstate(over="ignore"):
            for d, (gates, u_gates, u_new, first) in enumerate(tables[0]):
                gates, first = gates.take(rows, axis=1, mode="clip"), first.take(rows, axis=1, mode="clip")
                h = None
                for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                    into = states[t, d * HIDDEN : (d + 1) * HIDDEN]
                    if h is None:
                        np.take(first, window[t], axis=1, out=into, mode="clip")
                        h = into
                        continue
                    x = gates.take(window[t], axis=1, mode="clip")
                    zr, c = x[: 2 * HIDDEN], x[2 * HIDDEN :]
                    zr += _times(u_gates, h)
                    np.exp(zr, out=zr)
                    zr += 1
                    np.reciprocal(zr, out=zr)
                    zr[HIDDEN:] *= h
                    c += _times(u_new, zr[HIDDEN:])
                    _squash(c)
                    c -= h
                    c *= zr[:HIDDEN]
                    if not full:
                        c *= words[t]
                    np.add(h, c, out=into)
                    h = into
            found = np.stack([_times(tables[1], h) for h in states])
            e = found[:, :HIDDEN]
            _squash(e)
        weight = np.einsum("k,tkn->tn", self.p["v"][:, 0], e)
        if not full:
            weight += np.where(words, 0, -30).astype(np.float32)
        weight -= weight.max(axis=0)
        np.exp(weight, out=weight)
        return (weight * found[:, HIDDEN]).sum(axis=0) / weight.sum(axis=0) + self.p["k"][0]

    def gradients(self, values: np.ndarray, places: np.ndarray, mask: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss, by going back through time; inputs are (time, windows, ...)."""
        store: list = []
        logit = self.run(self.projected(values, places), mask, store)
        states, e, weight, pooled = store.pop()
        g = {k: np.zeros_like(p) for k, p in self.p.items()}
        d_logit = ((sigmoid(logit) - y) * w / w.sum())[:, None].astype(np.float32)
        g["o"], g["k"] = pooled.T @ d_logit, d_logit.sum(axis=0)
        d_pooled = d_logit @ self.p["o"].T
        d_weight = (states * d_pooled).sum(axis=2)
        d_states = weight[..., None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_e = d_score[..., None] * self.p["v"][:, 0] * (1 - e * e)
        g["v"] = np.einsum("tnk,tn->k", e, d_score)[:, None]
        g["a"] = np.einsum("tni,tnk->ik", states, d_e)
        d_states += d_e @ self.p["a"].T
        x = np.concatenate([values, self.p["vectors"][places]], axis=-1)
        d_x = np.zeros_like(x)
        carry = {d: np.zeros((mask.shape[1], HIDDEN), np.float32) for d in (0, 1)}
        for d, t, h, z, r, c, m in reversed(store):
            name = "fb"[d]
            u = self.p[f"u{name}"]
            d_h = carry[d] + d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            d_c = d_h * m * z * (1 - c * c)
            d_z = d_h * m * (c - h) * z * (1 - z)
            d_rh = d_c @ u[:, 2 * HIDDEN :].T
            d_r = d_rh * h * r * (1 - r)
            gate = np.concatenate([d_z, d_r, d_c], axis=1)
            g[f"u{name}"][:, : 2 * HIDDEN] += h.T @ gate[:, : 2 * HIDDEN]
            g[f"u{name}"][:, 2 * HIDDEN :] += (r * h).T @ d_c
            g[f"w{name}"] += x[t].T @ gate
            g[f"c{name}"] += gate.sum(axis=0)
            d_x[t] += gate @ self.p[f"w{name}"].T
            carry[d] = d_h * (1 - m * z) + d_rh * r + gate[:, : 2 * HIDDEN] @ u[:, : 2 * HIDDEN].T
        np.add.at(g["vectors"], places.ravel(), d_x[..., 4:].reshape(-1, VECTOR))
        g["vectors"][0] = 0
        return g

    def fit(self, values: np.ndarray, places: np.ndarray, mask: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 12, batch: int = 256) -> None:
        """Adam steps over windows given as (windows, time, ...)."""
        r = np.random.default_rng(11)
        first, second = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(rounds):
            order = r.permutation(len(y))
            for own in np.array_split(order, max(1, len(order) // batch)):
                g = self.gradients(values[own].swapaxes(0, 1), places[own].T, mask[own].T, y[own], w[own])
                step += 1
                for k in self.p:
                    first[k] = 0.9 * first[k] + 0.1 * g[k]
                    second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                    self.p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8) + 1e-4 * 0.01 * self.p[k]


@dataclass
class Scorer:
    """All that scoring needs: inputs, network, and the curve's weights; or one score for every text."""

    inputs: Inputs
    network: Network | None = None
    curve: tuple[float, float, float] = (0.0, 1.0, 0.0)
    constant: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_known", "_table")}

    @cached_property
    def _known(self) -> dict[str, int]:
        return {}

    @cached_property
    def _table(self) -> dict:
        """Distinct inputs of words, to hundredths; row 0 is the place without a word."""
        return {"row": {}, "inputs": [(0.0, 0.0, 0.0, 0.0, 0)]}

    def _rows(self, cut: list[list[str]]) -> list[np.ndarray]:
        known, table = self._known, self._table
        if len(known) > REMEMBERED or len(table["row"]) > 200_000:
            known.clear()
            table["row"].clear()
            del table["inputs"][1:]
        place, row_of, inputs = self.inputs.place, table["row"], table["inputs"]

        def row(key: tuple[float, float, float, float, int]) -> int:
            if key not in row_of:
                row_of[key] = len(inputs)
                inputs.append(key)
            return row_of[key]

        new = list(set().union(*cut).difference(known))
        known.update(dict.fromkeys(new, row((0.0, 0.0, 0.0, 0.0, 0))))
        for w, (a, b, c, d) in self.inputs.telling(new).items():
            known[w] = row((round(a, 2), round(b, 2), round(c, 2), round(d, 2), place.get(w, 0)))
        return [np.fromiter(map(known.__getitem__, own), np.int32, len(own)) for own in cut]

    def peaks(self, texts: list[str]) -> list[tuple[float, int]]:
        """The highest window logit of each text, and its number of windows. Windows of equal words give
        equal logits, which are computed once."""
        rows = self._rows([words(t) for t in texts])
        inputs = np.array(self._table["inputs"], np.float32)
        tables = self.network.tables(inputs[:, :4], inputs[:, 4].astype(int))
        counts = [1 + max(0, len(r) - WINDOW) for r in rows]
        flat = np.zeros(sum(n - 1 + WINDOW for n in counts), np.int32)
        starts, at = [], 0
        for r, n in zip(rows, counts, strict=True):
            flat[at : at + len(r)] = r
            starts.append(at + np.arange(n))
            at += n - 1 + WINDOW
        begin = np.concatenate(starts) if starts else np.empty(0, int)
        once, same = _distinct(flat, begin)
        order = np.argsort(once)
        logits = np.empty(len(once), np.float32)
        for i in range(0, len(once), BATCH):
            own = order[i : i + BATCH]
            places, at = _places(once[own])
            logits[own] = self.network.logits_at(tables, flat[places], at + np.arange(WINDOW)[:, None])
        logits = logits[same]
        edges = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(int)
        top = np.maximum.reduceat(logits, edges) if len(texts) else []
        return [(float(t), n) for t, n in zip(top, counts, strict=True)]

    def score(self, texts: list[str]) -> list[float]:
        if self.network is None:
            return [self.constant] * len(texts)
        bias, slope, length = self.curve
        return [1 / (1 + math.exp(-max(-30, min(30, bias + slope * top + length * math.log(n))))) for top, n in self.peaks(texts)]


def _places(begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that windows with rising beginnings cover, each once, and where each window begins in them."""
    new = np.minimum(np.diff(begin, prepend=begin[0] - WINDOW), WINDOW)  # places no earlier window covers
    end = np.cumsum(new)
    places = np.repeat(begin + WINDOW - end, new) + np.arange(end[-1])
    return places, end - WINDOW


def _distinct(flat: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of each kind of equal windows begins, and which of these each window equals."""
    key = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    width = 1
    while width < WINDOW and len(key) > width:  # keys of twice as many places from two that meet; WINDOW is a power of 2
        key ^= key >> np.uint64(29)
        key = key[:-width] * np.uint64(0xBF58476D1CE4E5B9) + key[width:]
        width *= 2
    _, first, same = np.unique(key[begin], return_index=True, return_inverse=True)
    once = begin[first]
    other = np.zeros(len(begin), bool)  # of equal keys and different words, should that ever be
    repeated = np.flatnonzero(once[same] != begin)
    a, b = begin[repeated], once[same[repeated]]
    for k in range(WINDOW):
        other[repeated] |= flat[a + k] != flat[b + k]
    if other.any():
        same[other] = len(once) + np.arange(other.sum())
        once = np.concatenate([once, begin[other]])
    return once, same


def _curve(points: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of labels on the highest logit and the logarithm of the number of windows.

    Newton's steps, each halved until it lowers the loss enough; the loss has one minimum, so they end
    there wherever the points lie."""
    x = np.column_stack([np.ones(len(y)), points[:, 0], np.log(points[:, 1])])
    beta, prior, weight = np.array([0.0, 1.0, 0.0]), np.array([0.0, 1.0, 0.0]), np.array([0.01, 0.1, 0.1])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((np.logaddexp(0, z) - y * z).sum() + (weight * (b - prior) ** 2).sum() / 2)

    now = loss(beta)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (p - y) + weight * (beta - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(weight), slope)
        size, then = 1.0, loss(beta - step)
        while then > now - 1e-4 * size * (slope @ step) and size > 1e-10:
            size /= 2
            then = loss(beta - size * step)
        if not then < now:
            break
        beta, now = beta - size * step, then
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """A scorer from labels (id, toxic: 1 or 0) and the texts they belong to."""
    own = labels.select(F.col(id).cast("long").alias("id"), F.col(toxic).cast("int").alias("toxic"))
    own = own.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    known = texts.join(F.broadcast(own), "id")  # at most ``sample`` ids and labels
    known = known.select("text", "toxic", (F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5)) == 0).alias("late"), F.xxhash64("id").alias("seed"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                distinct = set(words(t or ""))
                held[label > 0].update(distinct)
                held[label > 0].update({g for w in distinct for g in grams(w)})
                held[label > 0][""] += 1  # texts
        for label, found in held.items():
            n = pa.array(list(found.values()), pa.int64())
            none = pa.array(np.zeros(len(found), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), n if label else none, none if label else n], names=["feature", "toxic", "other"])

    early = known.where("not late").select("text", "toxic").mapInArrow(counted, "feature string, toxic long, other long")
    sums = early.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    sums = sums.where("a + b >= 3 or feature = ''")
    totals = sums.where("feature = ''").first()
    if totals is None or not totals["a"] or not totals["b"]:
        share = 0.0 if totals is None else totals["a"] / (totals["a"] + totals["b"])
        return Scorer(Inputs(), constant=float(share))
    n_a, n_b = totals["a"], totals["b"]
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    strength = F.abs(F.log(a / (n_a + 1)) - F.log(b / (n_b + 1))) / F.sqrt(1 / a + 1 / b)
    best = sums.where("feature <> ''").withColumn("z", strength).where("z > 2").orderBy(F.desc("z"), "feature").limit(KEPT)
    inputs = Inputs(n_toxic=n_a, n_other=n_b)
    for feature, x, y, _ in best.collect():
        # words have no marks; unmarked n-grams may equal words and stand for both
        if not feature.startswith("^") and not feature.endswith("$"):
            inputs.words[feature] = (x, y)
        if len(feature) in NGRAMS:
            inputs.grams[feature] = (x, y)
    shipped = ship(docs, inputs)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = shipped.value, shipped.value.place
        out: list[list] = [[], [], [], []]
        for batch in batches:
            for t, label, seed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                label, cut = int(label > 0), words(t or "")
                each = {w: held.values(w, label) for w in set(cut)}
                rows = [each[w] for w in cut]
                n = 1 + max(0, -(-(len(cut) - WINDOW) // STRIDE))
                tops = [max((max(r[0], r[1]) for r in rows[k * STRIDE : k * STRIDE + WINDOW]), default=0.0) for k in range(n)]
                first = max(range(n), key=tops.__getitem__)
                chosen = [first] if label else [first, *np.random.default_rng(seed & 0xFFFFFFFF).integers(n, size=3).tolist()]
                for k in dict.fromkeys(chosen):
                    part, names = rows[k * STRIDE : k * STRIDE + WINDOW], cut[k * STRIDE : k * STRIDE + WINDOW]
                    gap = WINDOW - len(part)
                    out[0].append(label)
                    out[1].append([v for r in part for v in r] + [0.0] * 4 * gap)
                    out[2].append([place.get(w, 0) for w in names] + [0] * gap)
                    out[3].append(len(part))
        types = (pa.int32(), pa.list_(pa.float32()), pa.list_(pa.int32()), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names=["label", "inputs", "places", "n"])

    made = "label int, inputs array<float>, places array<int>, n int"
    rows = sorted(known.where("not late").select("text", "toxic", "seed").mapInArrow(windows, made).collect())
    y = np.array([r[0] for r in rows], np.float32)
    values = np.array([r[1] for r in rows], np.float32).reshape(len(rows), WINDOW, 4)
    places = np.array([r[2] for r in rows], np.int64)
    mask = (np.arange(WINDOW) < np.array([r[3] for r in rows])[:, None]).astype(np.float32)
    network = Network(len(inputs.place))
    network.fit(values, places, mask, y, np.where(y > 0, math.sqrt((y == 0).sum() / max(1, (y > 0).sum())), 1.0).astype(np.float32))
    scorer = Scorer(inputs, network)
    fitted = ship(docs, scorer)

    def peaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                found = fitted.value.peaks([t or "" for t in rows.column(0).to_pylist()])
                columns = [rows.column(1), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "top", "n"])

    late = sorted(known.where("late").select("text", "toxic").mapInArrow(peaks, "label int, top double, n int").collect())
    if late:
        scorer.curve = _curve(np.array([r[1:] for r in late], float), np.array([r[0] > 0 for r in late], float))
    return scorer


def score(docs: DataFrame, scorer: Scorer, text: str = "text", into: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the toxicity of each whole text, from 0 to 1."""
    shipped = ship(docs, scorer)

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        return {into: shipped.value.score(texts)}

    return map_text(docs, text, f"`{into}` double", work, keep)
