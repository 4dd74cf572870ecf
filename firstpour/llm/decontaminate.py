"""Benchmark passages in training texts, found by spaced seeds and confirmed token by token.

Tokens are runs of word characters in lower case. A text holds a passage of a benchmark item where
13 tokens in a row of both agree in at least 11; of shorter items, all tokens take part and one may
differ from 7 tokens on. Items under 5 tokens are too short to tell.

Seeds are masks laid over the tokens: each looks at seven places of a window and ignores the rest.
The three masks for 13 tokens are chosen so that any two substitutions leave one of them untouched
somewhere in the window, so none is missed; short items have seeds of the same property. Hashes of
the seeds of the benchmark are joined with those at every place of every text inside tasks. A hit
fixes how item and text lie to each other, and the whole item is then compared along that line.

The benchmark is cut into pieces and goes to the tasks in blocks of bounded size, one after the
other, each against all texts; more of it means more blocks, not larger ones. Whole texts are read.
Null texts count as empty and overlap nothing, null items are left out, and repeated rows on either
side give repeated or the same overlaps. An empty benchmark overlaps nothing. Other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship, unused

WINDOW, EQUAL, SHORTEST = 13, 11, 5
#: Any two of 13 places leave one of these untouched somewhere; found by trying all pairs.
MASKS = ((0, 1, 3, 5, 6, 7, 8), (0, 1, 2, 3, 4, 7, 9), (0, 1, 5, 6, 9, 10, 11))
#: Tokens of a piece, and pieces in a block: at most about two million tokens travel at once.
PIECE, PIECES = 1000, 2000
TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def allowed(n: int) -> tuple[int, int]:
    """Window of an item of n tokens, and how many of it have to agree."""
    return (WINDOW, EQUAL) if n >= WINDOW else (n, n - (n > 6))


def masks(n: int) -> tuple[tuple[int, ...], ...]:
    if n >= WINDOW:
        return MASKS
    half = n // 2
    return (tuple(range(half)), tuple(range(half, n))) if n > 6 else (tuple(range(n)),)


class Seeds:
    """A block of the benchmark: pieces as (item_id, first token's place, tokens, the item's number of tokens)."""

    def __init__(self, pieces: list[tuple[int, int, list[str], int]]):
        self.pieces = pieces

    @cached_property
    def _built(self) -> None:
        words = sorted({w for p in self.pieces for w in p[2]})
        self.number = {w: i + 1 for i, w in enumerate(words)}
        random = np.random.default_rng(13)
        self.value = random.integers(1, 2**63, len(words) + 1, dtype=np.uint64)
        self.factor = random.integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.ids = [np.array([self.number[w] for w in p[2]], np.int64) for p in self.pieces]
        held: dict[tuple[int, ...], list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (piece, own) in enumerate(zip(self.pieces, self.ids, strict=True)):
            for mask in masks(piece[3]):
                at = np.arange(len(own) - mask[-1])
                if len(at):
                    held.setdefault(mask, []).append((self._hash(own, at, mask), at | (k << 20)))
        self.tables = {}
        for mask, parts in held.items():
            keys, places = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(keys, kind="stable")
            near = np.zeros(1 << 20, bool)
            near[keys >> np.uint64(44)] = True
            self.tables[mask] = (keys[order], places[order], near)

    def _hash(self, ids: np.ndarray, at: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for i, offset in enumerate(mask):
            out += self.value[ids[at + offset]] * self.factor[i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        return out

    def find(self, texts: list[str]) -> list[list[dict]]:
        """Overlaps of each text, one for each item and way it lies."""
        self._built  # noqa: B018
        number, numbered = self.number, []
        for t in texts:
            numbered.append(np.array([number.get(w, 0) for w in tokens(t)], np.int64))
        starts = np.cumsum([0] + [len(x) + 1 for x in numbered])
        ids = np.zeros(starts[-1] + 64, np.int64)  # a zero between texts agrees with nothing
        for x, s in zip(numbered, starts[:-1], strict=True):
            ids[s : s + len(x)] = x
        known = ids > 0
        lines: set[tuple[int, int]] = set()
        for mask, (keys, places, near) in self.tables.items():
            fits = known[: starts[-1]].copy()
            for offset in mask:
                fits &= known[offset : offset + starts[-1]]
            at = np.flatnonzero(fits)
            hashes = self._hash(ids, at, mask)
            some = near[hashes >> np.uint64(44)]
            at, hashes = at[some], hashes[some]
            low, high = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
            while (low < high).any():
                here = low < high
                at, low, high = at[here], low[here], high[here]
                found = places[low]
                lines.update(zip((found >> 20).tolist(), (at - (found & 0xFFFFF)).tolist(), strict=True))
                low = low + 1
        out: list[list[dict]] = [[] for _ in texts]
        for k, line in sorted(lines):
            _, first, _, n = self.pieces[k]
            own = self.ids[k]
            lower, upper = max(0, -line), min(len(own), len(ids) - line)
            same = np.zeros(len(own), np.int64)
            same[lower:upper] = own[lower:upper] == ids[line + lower : line + upper]
            window, least = allowed(n)
            if len(own) < window:
                continue
            total = np.concatenate([[0], np.cumsum(same)])
            good = np.flatnonzero(total[window:] - total[:-window] >= least)
            good = good[line + good >= 0]
            text = np.searchsorted(starts, line + good, "right") - 1
            inside = line + good + window < starts[np.minimum(text + 1, len(texts))]
            good, text = good[inside], text[inside]
            breaks = np.flatnonzero((np.diff(good) > 1) | (np.diff(text) > 0)) + 1
            for run, of in zip(np.split(good, breaks), np.split(text, breaks), strict=True):
                if len(run):
                    a, b, doc = int(run[0]), int(run[-1]) + window, int(of[0])
                    overlap = (self.pieces[k][0], line + a - int(starts[doc]), b - a, int(same[a:b].sum()), first + a)
                    out[doc].append(dict(zip(NAMES, overlap, strict=True)))
        return out


NAMES = ("item_id", "start", "n_tokens", "n_equal", "item_start")
OVERLAPS = "array<struct<item_id:bigint,start:bigint,n_tokens:int,n_equal:int,item_start:bigint>>"


def _pieces(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Items cut into pieces that overlap by less than a window, so that each window is in one piece whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = tokens(t)
                if len(own) >= SHORTEST:
                    for first in range(0, max(1, len(own) - WINDOW + 1), PIECE - WINDOW + 1):
                        for column, value in zip(rows, (item, first, own[first : first + PIECE], len(own)), strict=True):
                            column.append(value)
            types = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names=["item_id", "first", "words", "n"])

    own = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("text is not null")
    return own.mapInArrow(run, "item_id long, first long, words array<string>, n long").distinct()


def overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "overlaps",
    item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the overlaps of each text: item, where in the text, how long, how many tokens agree."""
    pieces = _pieces(benchmark, item_id, item_text)
    blocks = max(1, -(-pieces.count() // PIECES))
    kept = docs.columns if keep is None else keep
    found = docs.withColumn(into, F.array().cast(OVERLAPS))
    for block in range(blocks):
        own = pieces.where(F.pmod(F.xxhash64("item_id", "first", "words"), F.lit(blocks)) == block).collect()
        shipped = ship(docs, Seeds([(r[0], r[1], list(r[2]), r[3]) for r in own]))

        def work(rows: pa.RecordBatch, texts: list[str], shipped=shipped) -> dict[str, object]:
            before = rows.column(rows.schema.get_field_index(into)).to_pylist()
            return {into: [old + new for old, new in zip(before, shipped.value.find(texts), strict=True)]}

        last = block == blocks - 1
        found = map_text(found, text, f"`{into}` {OVERLAPS}", work, [c for c in kept if c != into] if last else [c for c in found.columns if c != into])
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark."""
    into = unused(docs, "overlaps")
    return overlaps(docs, benchmark, text, into).where(F.size(into) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
