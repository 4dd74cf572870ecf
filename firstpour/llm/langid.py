"""Language identification by rank-order profiles.

A text's profile lists its most frequent n-grams of one to three letters, words padded by a blank,
the most frequent first and of equally frequent ones the smaller code first. A language's profile is
made the same way from all its training texts, summed over tasks before anything is shuffled. The
distance of two profiles is how far the text's n-grams are out of place in the language's list, with
the list's length for those it lacks. The nearest language wins, the first by name among equals.

Whole texts are read. Texts that are null, empty or without a letter are ``und`` with score 0, and
so is every text when nothing was learned. Null languages are not learned from. Rows are independent:
repeated rows get repeated results, an empty table gives none. Other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship, slices, unused

#: N-grams in a profile.
SIZE = 300
OTHER = re.compile(r"[\W\d_]+")


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, sorted; empty without a letter. 21 bits for each letter."""
    letters = OTHER.sub(" ", text.lower()).strip()
    if not letters.replace(" ", "").isalpha():  # fractions and the like count as word characters
        letters = " ".join("".join(c if c.isalpha() else " " for c in letters).split())
    if not letters:
        return np.empty(0, np.int64)
    one = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    two = (one[:-1] << 21) | one[1:]
    three = (two[:-1] << 21) | one[2:]
    blank = one == 32
    codes = np.concatenate([one[~blank], two, three[~blank[1:-1]]])
    codes.sort()
    return codes


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, ascending, and how often each is there."""
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[starts], np.diff(np.append(starts, len(codes)))


def profiles(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> DataFrame:
    """(lang, code, place) of the most frequent n-grams of each language, places from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for rows in slices(batch, "text"):
                texts: dict[str, list[str]] = {}
                for language, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    texts.setdefault(language, []).append(t)
                for language, own in texts.items():
                    parts = [*held.get(language, []), counted(ngrams(" ".join(own)))]
                    held[language] = [_merged(parts)] if len(parts) > 8 else parts
        for language, parts in held.items():
            codes, counts = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"])

    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    sums = own.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return sums.withColumn("place", place - 1).where(F.col("place") < size).select("lang", "code", "place")


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


class Ranks:
    """Profiles of all languages as one table of places; what a language lacks counts as ``size``."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = SIZE):
        self.size, self.langs = size, sorted({r[0] for r in rows})
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64))
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        for language, code, place in rows:
            self.places[np.searchsorted(self.codes, code), self.langs.index(language)] = place

    def nearest(self, text: str) -> tuple[str, float]:
        codes, counts = counted(ngrams(text))
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = codes[np.argsort(-counts, kind="stable")[: self.size]]
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        places = self.places[np.where(self.codes[at] == top, at, len(self.codes))]
        apart = np.abs(places - np.arange(len(top), dtype=np.int32)[:, None])
        total = np.where(places < 0, self.size, apart).sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], 1.0 - float(total[best]) / (self.size * len(top))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> Ranks:
    """Profiles of the languages of ``docs``: ``size`` rows per language come to the driver."""
    return Ranks([tuple(r) for r in profiles(docs, lang, text, size).collect()], size)


def identify(docs: DataFrame, ranks: Ranks, text: str = "text", language: str = "lang_pred", score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the nearest language and how near it is, from 0 to 1."""
    shipped = ship(docs, ranks)

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        found = [shipped.value.nearest(t) for t in texts]
        return {language: [f[0] for f in found], score: [f[1] for f in found]}

    return map_text(docs, text, f"`{language}` string, `{score}` double", work, keep)


def identified(docs: DataFrame, ranks: Ranks, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language; all of them when no language was learned."""
    if not ranks.langs:
        return docs
    language, score = unused(docs, "lang_pred"), unused(docs, "score")
    return identify(docs, ranks, text, language, score).where(F.col(language) != "und").select(*[F.col(f"`{c}`") for c in docs.columns])
