"""Language-model scores by prediction by partial matching over bytes, learned from a whole corpus.

Contexts are the last five bytes. What follows each of them in the training texts is counted over all
tasks and summed; for shorter contexts each longer one that shows a byte counts once, so that they
tell what is new in a context. A byte is predicted from the longest
context seen in training. Where the context never showed that byte, the model escapes to the next
shorter one, leaving out the bytes it has just ruled out; the last resort is an even share of the
bytes still left. Escapes cost what method D gives them: half a count for each distinct byte. A text
starts after five boundary bytes and ends with one, so its probability covers where it stops.

The counts grow with the corpus and are never gathered in one place. Probabilities are worked out per
last two bytes of the context; the largest such group holds about a fiftieth of all distinct sequences of
a usual corpus, and grows with it. Only contexts of one byte, at most 65,536 counts, go to all tasks.
Texts are then dealt into blocks of about ``BLOCK_BYTES``, and each block gets the probabilities of just
the sequences it holds. Word counts of the base score travel the same way. A block is bounded by its
size, by one text, or by the rows that have one id and one beginning of a text, which share a block.

A-Z count as a-z throughout. Null and empty texts have no words and only their end. Without training
texts all bytes are equally likely. Rows without an id are like any other. Repeated rows count once each and get repeated results; an empty
table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm.tasks import ship, slices

ORDER = 5
EDGE = 255  # no byte of UTF-8 text, so it marks both ends
#: Bytes of text in a block.
BLOCK_BYTES = 25_000_000
#: Bytes of text in a block that are worked on at a time.
STEP_BYTES = 2_000_000


def sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the texts after its context, as 48-bit codes, and where each text begins."""
    pad = bytes([EDGE]) * ORDER
    raw = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    starts = np.cumsum([0] + [len(t) + ORDER for t in texts])
    codes = np.zeros(len(raw) - ORDER, np.int64)
    for i in range(ORDER + 1):
        codes <<= 8
        codes |= raw[i : i + len(codes)]
    inner = np.ones(len(codes), bool)
    for k in range(1, ORDER):  # only the first boundary byte after a text ends it
        inner[starts[1:-1] - k] = False
    return codes[: starts[-1] - ORDER + 1][inner[: starts[-1] - ORDER + 1]] if texts else codes[:0], starts[:-1] - (ORDER - 1) * np.arange(len(texts))


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """Distinct codes in order; sorting them is several times as fast as numpy's hashing."""
    codes = np.sort(np.concatenate(parts))
    return codes[np.concatenate([np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1]])]


def _word_codes(words: Iterable[bytes]) -> np.ndarray:
    """63 bits of a hash below zero, where no sequence's code is."""
    return np.array([xxhash.xxh3_64_intdigest(w) | 1 << 63 for w in words], np.uint64).view(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(codes, kind="stable")  # parts are mostly in order, which this kind makes use of
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def counts(docs: DataFrame) -> DataFrame:
    """(code, n): how often training texts have each sequence and word; 0 for those only others have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> pa.RecordBatch:
            codes, n = _added(held)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for rows in slices(batch, "text", 8_000_000):
                texts = [(t or b"").lower() for t in rows.column(0).cast(pa.binary()).to_pylist()]
                learned = rows.column(1).to_pylist()
                for train in (True, False):
                    own = [t for t, x in zip(texts, learned, strict=True) if x == train]
                    if own:
                        codes, n = np.unique(sequences(own)[0], return_counts=True)
                        words: Counter = Counter()
                        for t in own:
                            words.update(t.split())
                        held += [(codes, n * train), (_word_codes(words), np.fromiter(words.values(), np.int64, len(words)) * train)]
                if sum(len(p[0]) for p in held) > 3_000_000:
                    held = [_added(held)]
                    if len(held[0][0]) > 2_000_000:
                        yield merged()
                        held = []
        if held:
            yield merged()

    return docs.select("text", "train").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def probabilities(totals: DataFrame) -> DataFrame:
    """(code, value): the natural logarithm of the last byte's probability after the others."""
    grams = totals.where("code >= 0")
    short = grams.where("n > 0").select(F.col("code").bitwiseAND(0xFFFFFF).alias("code")).distinct()
    pairs = np.zeros((256, 256))
    for code, n in short.groupBy(F.col("code").bitwiseAND(0xFFFF)).count().collect():  # 65,536 at most
        pairs[code >> 8, code & 255] = n
    shipped = ship(totals, pairs)

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        order_1 = shipped.value
        codes, n = rows.code.to_numpy(), rows.n.to_numpy()
        context, symbol = codes >> 8, codes & 255
        known = codes[n > 0]
        shorter = {}  # order -> contexts, and how many longer contexts show each byte there
        for order in range(ORDER - 1, 1, -1):
            bits = (1 << 8 * (order + 2)) - 1
            longer = _distinct([known & bits])
            shorter[order] = np.unique(longer & (bits >> 8), return_counts=True)
        rest = (order_1[int(context[0] & 255)], (order_1 > 0).sum(axis=0))
        longest, at = np.unique(context, return_inverse=True)
        out, by = np.empty(len(codes)), np.argsort(at, kind="stable")
        for first in range(0, len(longest), 1024):
            part = longest[first : first + 1024]
            own = by[np.searchsorted(at[by], first) : np.searchsorted(at[by], first + 1024)]
            seen = np.zeros((len(part), 256))
            seen[at[own] - first, symbol[own]] = n[own]
            levels = [seen]
            for order in range(ORDER - 1, 1, -1):
                found, times = shorter[order]
                begin = (part & ((1 << 8 * order) - 1)) << 8
                low, high = np.searchsorted(found, begin), np.searchsorted(found, begin + 256)
                row = np.repeat(np.arange(len(part)), high - low)
                place = np.repeat(high - np.cumsum(high - low), high - low) + np.arange(len(row))
                level = np.zeros((len(part), 256))
                level[row, found[place] & 255] = times[place]
                levels.append(level)
            out[own] = predicted((*levels, *rest))[at[own] - first, symbol[own]]
        return pd.DataFrame({"code": codes, "value": out})

    near = F.shiftright("code", 8).bitwiseAND(0xFFFF)
    return grams.groupBy(near.alias("near")).applyInPandas(group, "code long, value double")


def predicted(levels: tuple[np.ndarray, ...]) -> np.ndarray:
    """Logarithms for all 256 bytes in each context, from counts of the longest to the shortest contexts."""
    rows = len(levels[0])
    out, escape, ruled_out = np.zeros((rows, 256)), np.zeros((rows, 1)), np.zeros((rows, 256), bool)
    for level in levels:
        left = np.where(ruled_out, 0, level)
        total, distinct = left.sum(axis=1, keepdims=True), (left > 0).sum(axis=1, keepdims=True)
        here = left > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.where(here, escape + np.log((left - 0.5) / total), out)
            escape = escape + np.where(total > 0, np.log(0.5 * distinct / total), 0)
        ruled_out |= here
    rest = 256 - ruled_out.sum(axis=1, keepdims=True)
    return np.where(ruled_out, out, escape - np.log(np.maximum(rest, 1)))


class Leaves:
    """Values of codes, by open addressing; only codes it was made of are asked for."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(codes) * 1.5).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        at = self._slot(codes)
        while len(codes):
            free = self.keys[at] < 0
            self.keys[at[free]] = codes[free]
            placed = self.keys[at] == codes  # of several at one place, the last
            self.values[at[placed]] = values[placed]
            codes, values, at = codes[~placed], values[~placed], (at[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = self._slot(codes)
        wrong = np.flatnonzero(self.keys[at] != codes)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.keys) - 1)
            wrong = wrong[self.keys[at[wrong]] != codes[wrong]]
        return self.values[at]


def _known(codes: np.ndarray, values: np.ndarray) -> tuple[Leaves, np.ndarray, np.ndarray]:
    """Values of sequences, and the codes of words in order with theirs."""
    grams = codes >= 0
    leaves = Leaves(codes[grams], values[grams])
    codes, values = codes[~grams], values[~grams]
    order = np.argsort(codes)
    return leaves, codes[order], values[order]


def _raw(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    return [(t or b"").lower() for t in table.column(table.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def packed(docs: DataFrame) -> DataFrame:
    """(block, sizes, texts): texts that a task has of a block, joined and compressed, and the size of each.

    For a shuffle: together they take less of its disk than each in a row of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for rows in slices(batch, "text", 8_000_000):
                blocks, sizes, joined = [], [], []
                at = rows.column(0).to_numpy()
                order = np.argsort(at, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                    for part in slices(rows.take(pa.array(own)), "text", STEP_BYTES):
                        texts = _raw(part)
                        blocks.append(at[own[0]])
                        sizes.append([len(t) for t in texts])
                        joined.append(codec.compress(b"".join(texts), asbytes=True))
                columns = [pa.array(blocks, pa.int32()), pa.array(sizes, pa.list_(pa.int32())), pa.array(joined, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "sizes", "texts"])

    return docs.select("block", "text").mapInArrow(run, "block int, sizes array<int>, texts binary")


def unpacked(table: pa.Table) -> Iterator[list[bytes]]:
    """The texts of ``packed`` rows, about ``STEP_BYTES`` at a time."""
    codec, texts, held = pa.Codec("zstd"), [], 0
    for rows in table.select(["sizes", "texts"]).to_batches():
        for sizes, joined in zip(rows.column(0), rows.column(1), strict=True):
            ends = np.cumsum(sizes.values.to_numpy(), dtype=np.int64).tolist()
            raw = codec.decompress(joined.as_buffer(), ends[-1], asbytes=True) if ends[-1] else b""
            texts += [raw[a:b] for a, b in pairwise([0, *ends])]
            held += len(raw)
            if held >= STEP_BYTES:
                yield texts
                texts, held = [], 0
    if texts:
        yield texts


def scored(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """A row per document: id, train, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``train`` holds. Tokens are words and one end; ``base_score`` adds up
    log10((c + 0.5) / (N + 0.5 (V + 1))) over them, ``score`` is the model's log10 probability.
    """
    spark = docs.sparkSession
    folder = folder or storage.scratch(spark, "ppm")
    own = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    totals = counts(own)
    totals.write.parquet(f"{folder}/totals")
    totals = spark.read.schema(totals.schema).parquet(f"{folder}/totals")

    size, learned = own.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
    words, different = totals.where("code < 0 and n > 0").agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = (words or 0) + learned
    below = tokens + 0.5 * (different + (learned > 0) + 1)

    block = F.pmod(F.xxhash64("id", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(blocks))
    dealt = own.withColumn("block", block.cast("int"))

    def held(table: pa.Table) -> pa.Table:
        parts: list[np.ndarray] = []
        for texts in unpacked(table):  # texts are taken apart a step at a time, too
            parts.append(_distinct([sequences(texts)[0], _word_codes(set().union(*(t.split() for t in texts)))]))
            if len(parts) > 8:
                parts = [_distinct(parts)]
        codes = _distinct(parts)
        at = pa.array(np.full(len(codes), table.column("block")[0].as_py(), np.int32))
        return pa.table([at, pa.array(codes)], names=["block", "code"])

    values = probabilities(totals).union(totals.where("code < 0").select("code", F.col("n").cast("double")))
    needed = packed(dealt).groupBy("block").applyInArrow(held, "block int, code long").join(values, "code").select("block", "code", "value")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by block, in each the codes and what is known of them first, then the texts."""
        block, codes, values, model = None, [], [], None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            texts = batch.column(1).to_numpy()
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | ((texts[1:] > 0) != (texts[:-1] > 0))) + 1
            for begin, end in pairwise([0, *edges.tolist(), len(blocks)]):
                part = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, codes, values, model = blocks[begin], [], [], None
                if not texts[begin]:
                    codes.append(part.column(3).to_numpy())
                    values.append(part.column(2).to_numpy())
                    continue
                if model is None:
                    model = _known(np.concatenate(codes), np.concatenate(values))
                    codes, values = [], []
                for rows in slices(part, "text", STEP_BYTES):
                    yield scores(rows, *model)
        del codes, values, model
        pa.default_memory_pool().release_unused()

    unknown = np.log10(0.5 / below)
    end_score = np.log10((learned + 0.5) / below)

    def scores(rows: pa.RecordBatch, leaves: Leaves, word_codes: np.ndarray, word_counts: np.ndarray) -> pa.RecordBatch:
        texts = _raw(rows)
        own_codes, starts = sequences(texts)
        total = np.add.reduceat(leaves(own_codes), starts) / np.log(10)
        cut = [t.split() for t in texts]
        distinct = list(set().union(*cut))
        c = word_counts[np.searchsorted(word_codes, _word_codes(distinct))]
        seen = dict(zip(distinct, np.log10((c + 0.5) / below).tolist(), strict=True))
        n_tokens, n_known, base = [], [], []
        for words in cut:
            each = np.fromiter(map(seen.__getitem__, words), float, len(words))
            n_tokens.append(len(words) + 1)
            n_known.append(int((each != unknown).sum()) + (learned > 0))
            base.append(float(each.sum()) + end_score)
        train = pa.array(rows.column(1).to_numpy() == 2)
        columns = [rows.column(3), train, pa.array(n_tokens), pa.array(n_known), pa.array([tokens] * len(texts)), pa.array(base), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    made = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # a block's rows come one batch after the other, so no task holds its texts at once; what changes
    # from row to row stands together, which packs better
    kind = F.when(F.col("train"), 2).otherwise(1)
    none = F.lit(None)
    rows = needed.select("block", F.lit(0).alias("kind"), "value", "code", none.cast("string").alias("text"))
    rows = rows.union(dealt.select("block", kind, none.cast("double"), "id", "text"))
    found = rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(score, made)
    return found.withColumnRenamed("id", id)
