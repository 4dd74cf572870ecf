"""Near-duplicate documents: MinHash with banding, checks on signatures and sets, and components.

A document's set holds its distinct word shingles. Sets are made once, as 64-bit hashes, inside
tasks; a set's many universal hash minima are its signature. Documents with equal sets fall together
first, in a partial aggregation, so thousands of copies are one set from there on. Sets that agree on
a band of the signature share a bucket; whether two are linked is confirmed on the full sets.

Buckets may be large, and not all pairs of one are made. Two rounds compare every set with one other
of its bucket, chosen anew each time, and join what is linked into components by alternating
large-star and small-star. Only where a bucket still holds several components are the sets outside
its largest one compared with the others, in blocks inside tasks, on the full sets. So a link is
missed only if no band has it (below 1e-8 for a pair right at the limit, less above it). Signatures
only spare the star rounds full sets that are far apart, five standard deviations off.

Nothing per document is collected to the driver. What later jobs need more than once is written to
the shared folder.

Null and empty texts and texts without words have an empty set and are linked with nothing; with
fewer words than a shingle takes, the whole text is one shingle. Rows without an id take no part: no
component, kept. Repeated rows are in one component, like any copies. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.functions.text import quoted
from firstpour.llm.tasks import map_text, unused

#: Hash minima in a signature.
MINIMA = 240
#: Rows of a bucket that a task compares at a time.
BLOCK = 512
#: Words whose hashes a task remembers.
REMEMBERED = 250_000
#: Words of 64 bits that mark which ids may be among many; a power of two.
MARKS = 1 << 18


def banding(percent: int, minima: int = MINIMA) -> tuple[int, int]:
    """Bands and rows for a limit: as many rows as miss at most 1 in 100 million pairs right at it."""
    for rows in range(12, 1, -1):
        if minima % rows == 0 and (1 - (percent / 100) ** rows) ** (minima // rows) < 1e-8:
            return minima // rows, rows
    return minima, 1


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes, and their signatures."""

    def __init__(self, words: int, minima: int = MINIMA):
        random = np.random.default_rng(20240115)
        self.words = words
        self.factors = random.integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.slopes = (random.integers(0, 2**31, minima, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.shifts = random.integers(0, 2**32, minima, dtype=np.uint32)[:, None]
        self.known: dict[bytes, int] = {}

    def hashes(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        mixed = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            mixed += each[i : len(each) - k + 1 + i] * self.factors[i]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    def signature(self, hashes: np.ndarray) -> bytes:
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        minima = None
        for part in np.array_split(low, -(-len(low) // 4096)):
            found = (self.slopes * part + self.shifts).min(axis=1)
            minima = found if minima is None else np.minimum(minima, found)
        return minima.astype(np.uint16).tobytes()  # the low halves tell minima apart


def _prints(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set: two sums, which do not depend on order."""
    other = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    other ^= other >> np.uint64(27)
    return int(hashes.sum(dtype=np.uint64).view(np.int64)), int((other * other + other).sum(dtype=np.uint64).view(np.int64))


def _saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sketch(docs: DataFrame, words: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: the size of its set, 128 bits for the set, and its signature."""
    shingler = Shingler(words)

    def work(rows: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        n, first, second, signs = [], [], [], []
        for t in texts:
            found = shingler.hashes(t.encode())
            a, b = _prints(found)
            n.append(len(found))
            first.append(a)
            second.append(b)
            signs.append(shingler.signature(found) if len(found) else None)
        return {"id": rows.column(0), "n_shingles": n, "print_1": first, "print_2": second, "signature": signs}

    made = "id long, n_shingles long, print_1 long, print_2 long, signature binary"
    return map_text(docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")), "text", made, work, keep=[])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are alike enough."""
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(run, "a long, b long")


def _alike(pairs: DataFrame, signs: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in at least so many places."""
    left, right = signs.toDF("a", "sign_a"), signs.toDF("b", "sign_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sign_a", "sign_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, folder: str, name: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it is joined with.

    Alternates large-star and small-star until nothing changes. Both are a minimum per node joined
    back, so a node with very many neighbours is a skewed join, not a group in one task.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v") if large else pairs.toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        found = both.join(low, "u")
        if large:
            out = found.where("v > u").select("v", "m")
        else:
            out = found.select("v", "m").union(low.select("u", "m"))
        return out.toDF("a", "b").where("a <> b").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, step = _saved(now, folder, f"{name}-0"), 0
    before = state(now)
    while before[0]:
        step += 1
        now = _saved(star(star(now, True), False), folder, f"{name}-{step}")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _stragglers(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of a bucket, but for those star rounds have found.

    ``rest``: key, rep, component of buckets with several components. What lies outside a bucket's
    largest component, its main one, is compared with all that shares a bucket with that component.
    A set comes once per main component, however many buckets it shares with it, and the comparison
    runs in blocks, on full sets by way of an index from shingles to sets.
    """
    per = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("key").agg(F.max(F.struct("n", F.negative("component").alias("x"))).alias("most"))
    of = main.select("key", F.negative("most.x").alias("main"))
    near = rest.join(of, "key").select("main", "rep", "component").distinct()
    sizes = near.groupBy("main").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("component") != F.col("main")).alias("few"))
    sizes = sizes.select("main", F.ceil(F.col("n") / BLOCK).alias("blocks_all"), F.ceil(F.col("few") / BLOCK).alias("blocks_few"))
    rows = near.join(sizes, "main").join(sets.toDF("rep", "shingles"), "rep")

    def dealt(kind: DataFrame, own: str, other: str, few: bool) -> DataFrame:
        block, copies = F.pmod(F.xxhash64("rep"), F.col(own)), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        names = ("j", "i") if few else ("i", "j")
        return kind.select("main", "rep", "component", "shingles", F.lit(few).alias("few"), block.alias(names[0]), copies.alias(names[1])).select(
            "main", "i", "j", "rep", "component", "shingles", "few"
        )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        few, every = block[block.few], block[~block.few]
        a: list[int] = []
        b: list[int] = []
        if len(few) and len(every):
            sets = [np.frombuffer(x, np.uint64) for x in every.shingles]
            sizes = np.array([len(x) for x in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            ids, groups = every.rep.to_numpy(), every.component.to_numpy()
            for rep, group, own in zip(few.rep, few.component, few.shingles, strict=True):
                own = np.frombuffer(own, np.uint64)
                low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                places = np.repeat(high - np.cumsum(high - low), high - low) + np.arange((high - low).sum())
                common = np.bincount(owner[places], minlength=len(sets))
                hit = (100 * common >= percent * (sizes + len(own) - common)) & (groups != group)
                # one link to each other component is enough to join it
                _, first = np.unique(groups[hit], return_index=True)
                a += [rep] * len(first)
                b += ids[hit][first].tolist()
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    every, few = dealt(rows, "blocks_all", "blocks_few", False), dealt(rows.where("component <> main"), "blocks_few", "blocks_all", True)
    return every.union(few).groupBy("main", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """A row per document: id, n_shingles, component_id, kept.

    Documents are linked where 100 times the common shingles is at least ``percent`` times all
    shingles. ``component_id`` is the smallest id that links reach, the document's own included;
    ``kept`` marks the document that has it.
    """
    spark: SparkSession = docs.sparkSession
    folder = folder or storage.scratch(spark, "minhash")
    bands, rows = banding(percent)
    limit = percent / 100
    least = math.floor(MINIMA * limit - 5 * math.sqrt(MINIMA * limit * (1 - limit)))

    sketches = _saved(sketch(docs, words, id, text), folder, "sketches")
    sets = sketches.where("id is not null and n_shingles > 0").groupBy("print_1", "print_2")
    sets = _saved(sets.agg(F.min("id").alias("rep"), F.first("signature").alias("signature")), folder, "sets")
    signs = sets.select("rep", "signature")

    key = lambda j: F.xxhash64(j, F.substring("signature", j * (2 * rows) + 1, F.lit(2 * rows)))
    buckets = sets.select("rep", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)).alias("key"))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = _saved(buckets.join(shared, "key"), folder, "members")  # key, rep, leader

    # the full sets of every document that shares a bucket, made once
    shingler = Shingler(words)
    chosen = members.select(F.col("rep").alias("id")).distinct()
    own = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(chosen, "id")
    full = map_text(
        own, "text", "rep long, shingles binary",
        lambda r, texts: {"rep": r.column(0), "shingles": [shingler.hashes(t.encode()).tobytes() for t in texts]}, keep=[],
    )
    full = _saved(full, folder, "full")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        return _saved(_confirm(_alike(pairs.distinct(), signs, least), full, percent), folder, name)

    ordered = (F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
    edges = linked(members.where("rep <> leader").select(*ordered), "links-1")
    for turn in (2, 3):
        found = components(edges, folder, f"components-{turn}")
        placed = members.select("key", "rep").join(found.toDF("rep", "component"), "rep", "left")
        placed = placed.withColumn("component", F.coalesce("component", "rep"))
        several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
        rest = _saved(placed.join(several, "key"), folder, f"rest-{turn}")
        if turn == 2:
            drawn = rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "rep"), "rep", "component")).alias("by"))
            drawn = drawn.select("key", F.col("by.rep").alias("leader"), F.col("by.component").alias("theirs"))
            more = linked(rest.join(drawn, "key").where("component <> theirs").select(*ordered), "links-2")
        else:
            more = _saved(_stragglers(rest, full, percent), folder, "links-3")
        edges = edges.union(more)
    found = components(edges, folder, "components-4").toDF("rep", "component")

    each = sketches.drop("signature").join(sets.drop("signature"), ["print_1", "print_2"], "left").join(found, "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", F.when(F.col("n_shingles") > 0, F.col("rep")), "id"))
    return each.select(
        F.col("id").alias(id),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _marked(docs: DataFrame, ids: DataFrame, id: str, into: str) -> DataFrame:
    """``docs`` with a flag that holds for all rows whose id is in ``ids``, and for few others.

    A bit is set for the hash of each id; at most ``MARKS`` words of them go to all tasks, so no text is
    shuffled to set the flag.
    """
    word, bits = unused(docs, "word"), unused(docs, "bits")

    def at(column: str) -> tuple[Column, Column]:
        hashed = F.xxhash64(F.col(quoted(column)).cast("long"))
        return hashed.bitwiseAND(MARKS - 1), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))

    own, bit = at(ids.columns[0])
    marks = ids.select(own.alias(word), bit.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    own, bit = at(id)
    joined = docs.withColumn(word, own).join(F.broadcast(marks), word, "left")
    flag = F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False)).alias(into)
    return joined.select(*[F.col(quoted(c)) for c in docs.columns], flag)


def deduplicate(
    docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: that with the smallest id.

    Of rows with one id, one stays if their text is that of a group's smallest id; rows without an id
    all stay. Only rows whose id may be a dropped or repeated one are shuffled with their texts.
    """
    folder = folder or storage.scratch(docs.sparkSession, "dedup")
    found = near_duplicates(docs.select(id, text), words, percent, id, text, folder).where(F.col(id).isNotNull())
    by = _saved(found.groupBy(F.col(id).alias("id")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), folder, "kept")
    once, many = by.where("not kept or n > 1").select("id"), by.where("kept and n > 1").select("id")
    flag = unused(docs, "flag")
    marked = _marked(docs, once, id, flag)
    once, many = once.withColumnRenamed("id", id), many.withColumnRenamed("id", id)
    looked_up = marked.where(F.col(flag)).drop(flag)
    out = marked.where(~F.col(flag)).drop(flag).union(looked_up.join(once, looked_up[id] == once[id], "left_anti"))
    if not many.isEmpty():
        out = out.union(looked_up.join(many, looked_up[id] == many[id], "left_semi").dropDuplicates([id]))
    return out
