"""SimHash near-duplicates: fingerprints in a grid of segment bit counts, exact links, components.

A text's word shingles, repeats included, vote on 64 bits through their XXH64; a bit is one where more
than half of them have it. Documents with equal fingerprints fall together first, in a partial
aggregation, so thousands of copies are one fingerprint from there on.

Fingerprints that differ in few bits are found through an embedding: each maps to the number of ones
in each of its 32 segments of two bits. The Manhattan distance of two such points is never above the
number of differing bits. Written in unary, segment by segment, a point fits a 64-bit number again, and
that distance is the number of ones of an exclusive or. The range join runs over a grid: the segments
are dealt to ``g`` groups, and points within a distance of ``k`` agree on all segments of at least
``g - k`` groups, so each choice of ``g - k`` groups is a set of cells, and points in range share a
cell of at least one choice. ``g`` grows with the number of fingerprints, so that a fingerprint meets
about one stranger whatever their number. Within a cell the distance of the points comes first; what
passes is verified on all bits of the fingerprints.

Cells may be large, and their pairs are not made. What a cell contributes is a spanning forest of its
links, found by a search over the members not reached yet; more links would not change a component. A
cell beyond ``TILE`` members is searched in tiles of two blocks, each a group of its own. Fingerprints
of a cell beyond ``MOST`` members are linked another exact way, whose work grows with their number
only: two fingerprints differ in at most ``k`` bits where some point lies within ``k - k/2`` bits of
one and ``k/2`` bits of the other, so each goes to the points around it, and at each point all that are
near are linked with the smallest of those that are nearest.

Nothing per document is collected to the driver. What later jobs need more than once is written to
the shared folder.

Null and empty texts and texts without words have the fingerprint zero, which is linked like any other;
with fewer words than a shingle takes, the whole text is one shingle. Very long texts are read in
stretches of ``STRETCH`` bytes. Rows without an id take no part: they have a fingerprint, no component.
Repeated rows, and rows with one id and different texts, each have their own fingerprint's component.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm.minhash import components
from firstpour.llm.tasks import map_text

#: Bits of a segment.
SEGMENT = 2
#: Members of a cell that are searched at once.
TILE = 4096
#: Members of a cell up to which tiles are used.
MOST = 32_768
#: Members up to which all pairs of a cell are compared at once.
FEW = 8
#: Bytes of a text read at a time.
STRETCH = 1 << 20
BLANK = re.compile(rb"[ \t-\r]")


class Fingerprinter:
    """64 majority bits over the hashes of a text's word shingles."""

    def __init__(self, words: int = 3, seed: int = 42, stretch: int = STRETCH):
        self.words, self.seed, self.stretch = words, seed, stretch

    def _stretches(self, text: bytes) -> Iterator[list[bytes]]:
        """Runs of words that overlap by one word less than a shingle has."""
        at, carried = 0, []
        while at < len(text):
            end = BLANK.search(text, at + self.stretch)
            stop = end.start() if end else len(text)
            words = carried + text[at:stop].split()
            if len(words) >= self.words or stop == len(text):
                yield words
                carried = words[len(words) - self.words + 1 :] if self.words > 1 else []
            else:
                carried = words
            at = stop

    def _hashes(self, words: list[bytes], k: int) -> np.ndarray:
        joined = b" ".join(words)
        ends = list(accumulate([len(w) + 1 for w in words]))
        digest, seed = xxhash.xxh64_intdigest, self.seed
        starts = [0, *ends[: len(words) - k]]
        return np.fromiter([digest(joined[s : e - 1], seed) for s, e in zip(starts, ends[k - 1 :], strict=True)], np.uint64)

    def fingerprint(self, text: str) -> int:
        """As a signed 64-bit number."""
        ones, n, last = np.zeros(64, np.int64), 0, []
        for words in self._stretches(text.encode().lower()):  # bytes: A-Z only, and ASCII white space only
            last = words
            if len(words) < self.words:
                continue
            hashes = self._hashes(words, self.words)
            n += len(hashes)
            for part in range(0, len(hashes), 65_536):
                bits = np.unpackbits(hashes[part : part + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
        if not n and last:  # fewer words than a shingle takes
            return int(self._hashes(last, len(last)).view(np.int64)[0])
        return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: id and fingerprint."""
    maker = Fingerprinter(words)
    return map_text(
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")), "text", "id long, fingerprint long",
        lambda rows, texts: {"id": rows.column(0), "fingerprint": [maker.fingerprint(t) for t in texts]}, keep=[],
    )


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def embedded(fingerprint: Column, width: int = SEGMENT) -> Column:
    """The ones of each segment of ``width`` bits, in unary, segment by segment."""
    found = F.lit(0).cast("long")
    for at in range(0, 64, width):
        ones = F.bit_count(fingerprint.bitwiseAND(F.lit(_signed(((1 << width) - 1) << at)).cast("long")))
        unary = F.call_function("shiftleft", F.lit(1).cast("long"), ones) - F.lit(1).cast("long")
        found = found.bitwiseOR(F.shiftleft(unary, at))
    return found


def embedded_values(fingerprints: np.ndarray, width: int = SEGMENT) -> np.ndarray:
    """The same inside tasks, over unsigned 64-bit numbers."""
    found, one = np.zeros_like(fingerprints), np.uint64(1)
    for at in range(0, 64, width):
        ones = np.bitwise_count(fingerprints & np.uint64(((1 << width) - 1) << at)).astype(np.uint64)
        found |= ((one << ones) - one) << np.uint64(at)
    return found


def groups_for(n: int, differ: int, width: int = SEGMENT) -> int:
    """Groups of segments for ``n`` fingerprints: the fewest with which one meets at most about one
    stranger by chance."""
    counts = [comb(width, i) / 2**width for i in range(width + 1)]
    bits = -log2(sum(p * p for p in counts)) * 64 / width
    most = 64 // width
    for g in range(differ + 1, most):
        if n * comb(g, differ) * 2 ** (-bits * (g - differ) / g) <= 1:
            return g
        if comb(g + 1, differ) > 500:
            return g
    return most


def cell_masks(groups: int, differ: int, width: int = SEGMENT) -> list[int]:
    """For each choice of ``groups - differ`` groups, the bits of the embedding that make its cells."""
    segments = 64 // width
    borders = [segments * i // groups * width for i in range(groups + 1)]
    masks = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(borders, borders[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(masks, groups - differ)]


class Links:
    """Links within cells, each point of view: members (distinct unsigned fingerprints) of one cell."""

    def __init__(self, differ: int, width: int = SEGMENT):
        self.differ, self.width = differ, width

    def _near(self, values: np.ndarray, points: np.ndarray, i: int, among: np.ndarray) -> np.ndarray:
        """Which of ``among`` member ``i`` is linked with: in range in the grid, then by all bits."""
        near = np.bitwise_count(points[among] ^ points[i]) <= self.differ
        near[near] = np.bitwise_count(values[among[near]] ^ values[i]) <= self.differ
        return near

    def forest(self, values: np.ndarray, left: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links: of all members, or between the first ``left`` and the rest."""
        points = embedded_values(values, self.width)
        one = np.arange(len(values) if left is None else left)
        fresh = [one, one if left is None else np.arange(left, len(values))]
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        todo: list[int] = []
        while True:
            if not todo:
                if not len(fresh[0]):
                    break
                todo, fresh[0] = [int(fresh[0][0])], fresh[0][1:]
                if left is None:
                    fresh[1] = fresh[0]
            i = todo.pop()
            other = 0 if left is None or i >= left else 1
            near = self._near(values, points, i, fresh[other])
            if near.any():
                found = fresh[other][near]
                a.append(np.full(len(found), i))
                b.append(found)
                todo += found.tolist()
                fresh[other] = fresh[other][~near]
                if left is None:
                    fresh[1] = fresh[0]
        if not a:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        return values[np.concatenate(a)], values[np.concatenate(b)]

    def small(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links of many cells of at most ``FEW`` members, which lie one behind another in ``flat``."""
        points = embedded_values(flat, self.width)
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # members from here to the cell's end
        a, b = [], []
        for step in range(1, int(sizes.max(initial=0))):
            i = np.flatnonzero(room > step)
            i = i[np.bitwise_count(points[i] ^ points[i + step]) <= self.differ]
            i = i[np.bitwise_count(flat[i] ^ flat[i + step]) <= self.differ]
            a.append(flat[i])
            b.append(flat[i + step])
        return (np.concatenate(a), np.concatenate(b)) if a else (flat[:0], flat[:0])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and list sizes of an array column."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return flat.astype(np.int64, copy=False).view(np.uint64), np.diff(offsets)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _of_cells(cells: DataFrame, differ: int) -> DataFrame:
    """Links (a, b) of cells given as arrays ``members`` of at most ``TILE`` fingerprints."""
    links = Links(differ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _lists(batch.column(0))
            few = sizes <= FEW
            yield _pairs(*links.small(flat[np.repeat(few, sizes)], sizes[few]))
            ends = np.cumsum(sizes)
            for i in np.flatnonzero(~few):
                yield _pairs(*links.forest(flat[ends[i] - sizes[i] : ends[i]]))

    return cells.select("members").mapInArrow(run, "a long, b long")


def _of_tiles(large: DataFrame, differ: int, tile: int) -> DataFrame:
    """Links (a, b) of cells (key, fingerprint, n) of more than ``tile`` members, two blocks at a time."""
    links = Links(differ)
    blocks = F.ceil(F.col("n") / tile)
    placed = large.select("key", "fingerprint", blocks.alias("blocks"), F.pmod(F.xxhash64("fingerprint"), blocks).alias("own"))
    dealt = placed.select("key", "fingerprint", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    tiles = dealt.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list(F.when(F.col("own") <= F.col("other"), F.col("fingerprint"))).alias("left"),
        F.collect_list(F.when(F.col("own") > F.col("other"), F.col("fingerprint"))).alias("right"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (one, n), (two, m) = (_lists(batch.column(c).slice(i, 1)) for c in (1, 2))
                same = batch.column(0)[i].as_py()
                if same:
                    yield _pairs(*links.forest(one))
                elif n[0] and m[0]:
                    yield _pairs(*links.forest(np.concatenate([one, two]), int(n[0])))

    return tiles.select(F.expr("i = j").alias("same"), "left", "right").mapInArrow(run, "a long, b long")


def _of_points(crowd: DataFrame, differ: int) -> DataFrame:
    """Links (a, b) among all fingerprints of ``crowd``, through the points around them."""
    near, far = differ // 2, differ - differ // 2
    masks = [sum(1 << bit for bit in bits) for k in range(far + 1) for bits in combinations(range(64), k)]
    flips = np.array(masks, np.uint64)
    close = np.bitwise_count(flips) <= near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for part in range(0, len(values), 64):
                some = values[part : part + 64]
                points = (some[:, None] ^ flips).ravel()
                columns = [points.view(np.int64), np.repeat(some, len(flips)).view(np.int64), np.tile(close, len(some))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["point", "fingerprint", "close"])

    around = crowd.select("fingerprint").mapInArrow(run, "point long, fingerprint long, close boolean")
    # a point has at most as many neighbours as flips
    at = around.groupBy("point").agg(
        F.min(F.when(F.col("close"), F.col("fingerprint"))).alias("a"), F.collect_list("fingerprint").alias("near")
    )
    linked = at.where("a is not null and size(near) > 1").select("a", F.explode("near").alias("b"))
    return linked.where("a <> b").distinct()


def _saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def links(sets: DataFrame, n: int, differ: int, folder: str, tile: int = TILE, most: int = MOST) -> DataFrame:
    """Links (a, b) between ``n`` distinct fingerprints that join exactly those which links of at most
    ``differ`` differing bits join."""
    masks = cell_masks(groups_for(n, differ), differ)
    point = embedded(F.col("fingerprint"))
    keys = F.array([F.xxhash64(F.lit(i), F.col("point").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])
    placed = sets.select("fingerprint", point.alias("point")).select("fingerprint", F.explode(keys).alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # never broadcast: Spark sizes the keys as if the explode made no rows, and there are many for each fingerprint
    members = placed.join(shared.hint("merge"), "key")
    cells = members.where(F.col("n") <= tile).groupBy("key").agg(F.collect_list("fingerprint").alias("members"))
    found = _of_cells(cells, differ)
    large = _saved(members.where(F.col("n") > tile), folder, "large")  # key, fingerprint, n
    if not large.isEmpty():
        found = found.union(_of_tiles(large.where(F.col("n") <= most), differ, tile))
        crowd = large.where(F.col("n") > most).select("fingerprint").distinct()
        if not crowd.isEmpty():
            found = found.union(_of_points(crowd, differ))
    return found


def near_duplicates(
    docs: DataFrame, words: int = 5, differ: int = 3, id: str = "doc_id", text: str = "text", folder: str | None = None,
    tile: int = TILE, most: int = MOST,
) -> DataFrame:
    """A row per document: id, fingerprint (16 hexadecimal digits), component_id.

    Documents are linked where their fingerprints differ in at most ``differ`` bits. ``component_id`` is
    the smallest id that links reach, the document's own included.
    """
    folder = folder or storage.scratch(docs.sparkSession, "simhash")
    prints = _saved(fingerprints(docs, words, id, text), folder, "prints")
    sets = _saved(prints.where("id is not null").groupBy("fingerprint").agg(F.min("id").alias("rep")), folder, "sets")
    edges = links(sets, sets.count(), differ, folder, tile, most)
    found = _saved(components(edges, folder).toDF("fingerprint", "root").join(sets, "fingerprint"), folder, "found")
    low = found.groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = found.join(low, "root").select("fingerprint", "component_id")
    named = sets.join(joined, "fingerprint", "left").select("fingerprint", F.coalesce("component_id", "rep").alias("component_id"))
    each = prints.join(named, "fingerprint", "left")
    return each.select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
