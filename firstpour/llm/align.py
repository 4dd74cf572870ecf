"""Two tokenizers over the same texts: groups of tokens with common borders, and how often ids meet.

Both tokenizers cut a text's bytes (with one blank before it) into tokens. Where a token of each ends at
the same byte a group ends, so a text is a row of groups, the smallest runs of tokens that cover the
same bytes on both sides. Two tokens are linked where their bytes overlap.

What a stretch of bytes knows of this is a fragment: the tokens that end in it up to the first common
end (its open prefix), the groups between its common ends (closed), and the tokens after the last one
(its open suffix); without a common end all is open. Two neighbours make one fragment again: the suffix
of the first and the prefix of the second become a group, or stay open. That is associative, and the
fragment of no bytes changes nothing, so a long document is cut into byte ranges anywhere, even within
a token; their fragments are made by different tasks and composed as a tree, ``FAN`` neighbours a
time, round by round.

No token of either tokenizer goes beyond a word that a single blank divides from the next: the first
one splits such words before it looks for tokens, and no piece of the second has a blank behind another
character (both is checked when they are read; otherwise texts stay whole). So the words of a task are
tokenized once each, and a byte range is tokenized from the word its start lies in to that of its end.

Counting is a partial sum inside tasks, a sum per pair of ids, and a largest count per second id. The
most frequent pairs, ``OFTEN`` of them at most, go to all tasks; what is rarer, and therefore in no way
skewed, is joined with the documents that have it.

Null and empty texts, and texts whose tokens do not give back their bytes, have no tokens: zeros, and an
empty list of groups. Rows do not depend on each other but for the counts: a repeated row counts again.
An empty table gives an empty one. Other columns are not read. A very long text costs its bytes and its
list of groups, three to five times as much; a run of several million characters without a blank is
tokenized by one task, which takes some hundred bytes a character.
"""

from __future__ import annotations

import json
import os
import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm.bpe import _byte_letters
from firstpour.llm.tasks import map_text, ship

#: Characters of a text from which it is cut into ranges of that many.
RANGE = 32_768
#: Neighbouring fragments that are composed at a time.
FAN = 16
#: Pairs of ids whose counts are sent to all tasks.
OFTEN = 262_144
#: Words each half of a task's memory holds, and the characters of the longest among them.
REMEMBERED, LONGEST = 60_000, 48
#: Words a task remembers to have met.
MET = 400_000
#: Characters of words that are tokenized together.
TOGETHER = 100_000
#: Distinct pairs a task holds before it gives up their sums.
HELD = 1_000_000
#: Characters of a word up to which the faster encoder is used, whose time grows with their square.
LONG = 1000
#: Fixed value: how byte-level tokenizers split a text before they look for tokens.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Single blanks between words.
BORDER = re.compile(r"(?<=\S) (?=\S)")
BLANK_RUN, OTHER_BLANK = re.compile(r" \s"), re.compile(r"[^\S ] ")

MADE = "key long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


@dataclass(frozen=True)
class Closed:
    """Groups side by side: their number, their text, and the pairs of ids linked in them."""

    n: int
    text: str
    pairs: np.ndarray
    times: np.ndarray


@dataclass(frozen=True)
class Run:
    """Tokens side by side: ids and the bytes they end at, of both tokenizers."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Run) -> Run:
        return Run(*(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts(), strict=True)))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends


NONE = np.empty(0, np.int64)
NO_TOKENS = Run(NONE, NONE, NONE, NONE)


@dataclass(frozen=True)
class Fragment:
    """A stretch of bytes. Without a common end (``closed`` is None) all its tokens are the prefix."""

    n_a: int
    n_b: int
    prefix: Run
    closed: Closed | None
    suffix: Run


EMPTY = Fragment(0, 0, NO_TOKENS, None, NO_TOKENS)
EMPTY_CLOSED = Closed(0, "", NONE, NONE)
NOTHING = (0, 0, 0, "", NONE, NONE)


def packed(fragment: Fragment | None) -> bytes:
    """As bytes, between tasks."""
    if fragment is None:
        return pickle.dumps(None)
    c = fragment.closed
    closed = None if c is None else (c.n, c.text, c.pairs, c.times)
    return pickle.dumps((fragment.n_a, fragment.n_b, fragment.prefix.parts(), closed, fragment.suffix.parts()))


def unpacked(body: bytes) -> Fragment | None:
    held = pickle.loads(body)
    if held is None:
        return None
    n_a, n_b, prefix, closed, suffix = held
    return Fragment(n_a, n_b, Run(*prefix), None if closed is None else Closed(*closed), Run(*suffix))


class Pair:
    """Two tokenizers as their files; of fixed size, and built where it is used."""

    def __init__(self, first: str, second: bytes):
        self.first, self.second = first, second

    def __getstate__(self) -> dict:
        return {"first": self.first, "second": self.second}

    @cached_property
    def _built(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores out
        import sentencepiece
        from tokenizers import Tokenizer

        self.one = Tokenizer.from_str(self.first)
        self.one.encode_special_tokens = True
        self.one.no_truncation()
        self.one.no_padding()
        self.quick = self._quick(json.loads(self.first))
        self.two = sentencepiece.SentencePieceProcessor(model_proto=self.second)
        byte = {letter: i for i, letter in enumerate(_byte_letters())}
        spec = json.loads(self.first)
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        n = max([*names, *special]) + 1
        self.a_bytes = [special[i] if i in special else bytes(byte[c] for c in names.get(i, "")) for i in range(n)]
        pieces = [self.two.id_to_piece(i) for i in range(self.two.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.two.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in ts]) for ts in (self.a_bytes, self.b_bytes))
        # ids as they are shown: within a group and at the end of its first side, then the same for the second
        self.shown = [f"{i}{mark}" for size, ends in ((n, ",|"), (len(pieces), ",;")) for mark in ends for i in range(size)]
        self.shown_sizes = np.array([len(t) for t in self.shown])
        split = spec["pre_tokenizer"] or {}
        self.by_words = (
            split.get("type") == "ByteLevel" and split.get("use_regex", False) and not split.get("add_prefix_space", True)
            and spec["normalizer"] is None and b"\x08identity\x12\x00" in self.second
            and not any(re.search("[^▁]▁", p) for p in pieces)
        )
        self.known, self.before, self.once = {}, {}, set()

    def _quick(self, spec: dict):
        """The first tokenizer in a faster encoder, where its file is one that gives the same ids there: a
        byte-level vocabulary whose ids are in the order of its merges."""
        vocabulary, split = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if (
            split.get("type") != "ByteLevel" or not split.get("use_regex") or split.get("add_prefix_space") or spec["normalizer"]
            or spec["model"].get("ignore_merges") or any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(merges))
        ):
            return None
        import tiktoken

        byte = {letter: i for i, letter in enumerate(_byte_letters())}
        plain = {t: i for t, i in vocabulary.items() if i < 256 + len(merges)}
        ranks = {bytes(byte[c] for c in t): i for t, i in plain.items()}
        return tiktoken.Encoding("first", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @property
    def size_b(self) -> int:
        self._built  # noqa: B018
        return len(self.b_bytes)

    def forget(self) -> None:
        if "_built" in self.__dict__:
            self.known, self.before, self.once = {}, {}, set()

    def words(self, text: str) -> list[str]:
        """What is tokenized on its own: each piece stands for itself with a blank before it."""
        if not self.by_words:
            return [text]
        if text[0] != " " and text[-1] != " " and not BLANK_RUN.search(text) and not OTHER_BLANK.search(text):
            return text.split(" ")
        return BORDER.split(text)

    def tokens(self, words: list[str]) -> Run | None:
        """Tokens of words, each with a blank before it; None where they do not give back the bytes."""
        self._built  # noqa: B018
        text = " " + " ".join(words)
        if self.quick and max(map(len, words)) <= LONG:
            a = np.array(self.quick.encode_ordinary(text), np.int64)
        else:
            a = np.array(self.one.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.fromiter(chain.from_iterable(self.two.encode(words, num_threads=1)), np.int64)
        whole = text.encode()
        for ids, tokens in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(tokens.__getitem__, ids.tolist())) != whole:
                return None
        return Run(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]))

    def _entries(self, words: list[str]) -> list[tuple | None]:
        """(tokens a, tokens b, groups, their text, linked pairs) of each word, tokenized as one text."""
        run = self.tokens(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        if run is None or not (np.isin(ends, run.a_ends).all() and np.isin(ends, run.b_ends).all()):
            if len(words) == 1:
                return [None]
            half = len(words) // 2
            return self._entries(words[:half]) + self._entries(words[half:])
        steps, common = _merged(run.a_ends, run.b_ends)
        pairs = (run.a[np.searchsorted(run.a_ends, steps)] * len(self.b_bytes) + run.b[np.searchsorted(run.b_ends, steps)]).tolist()
        text, starts = self._listed(run, common)
        a, b, g, p = ([0, *np.searchsorted(e, ends, "right").tolist()] for e in (run.a_ends, run.b_ends, common, steps))
        at = starts[g].tolist()
        return [
            (a[i + 1] - a[i], b[i + 1] - b[i], g[i + 1] - g[i], text[at[i] : at[i + 1] - 1], tuple(pairs[p[i] : p[i + 1]]))
            for i in range(len(words))
        ]

    def _listed(self, run: Run, common: np.ndarray) -> tuple[str, np.ndarray]:
        """The groups of a run as one text, a semicolon after each, and where each of them starts in it."""
        n, many = len(self.a_bytes), len(self.b_bytes)
        cuts_a, cuts_b = (np.concatenate([[0], np.searchsorted(e, common, "right")]) for e in (run.a_ends, run.b_ends))
        codes = np.empty(len(run.a) + len(run.b), np.int64)
        last_a, last_b = np.zeros(len(run.a), np.int64), np.zeros(len(run.b), np.int64)
        last_a[cuts_a[1:] - 1], last_b[cuts_b[1:] - 1] = 1, 1
        codes[np.arange(len(run.a)) + cuts_b[np.searchsorted(common, run.a_ends)]] = run.a + last_a * n
        codes[np.arange(len(run.b)) + cuts_a[np.searchsorted(common, run.b_ends) + 1]] = run.b + last_b * many + 2 * n
        text = "".join(map(self.shown.__getitem__, codes.tolist()))
        reached = np.concatenate([[0], np.cumsum(self.shown_sizes[codes])])
        return text, reached[cuts_a + cuts_b]

    def learned(self, words: set[str]) -> dict[str, tuple | None]:
        """Entries of words, from memory where they are known. Words met a second time are remembered, in two
        halves: when the newer one is full it becomes the older one, of which only what is met again is kept."""
        self._built  # noqa: B018
        found, fresh, once = {}, [], self.once
        if len(once) > MET:
            once.clear()
        for w in words:
            entry = self.known.get(w, self)
            if entry is self:
                entry = self.before.get(w, self)
                if entry is self:
                    fresh.append(w)
                    continue
                self._remember(w, entry)
            found[w] = entry
        at = 0
        while at < len(fresh):
            stop, held = at, 0
            while stop < len(fresh) and (stop == at or held + len(fresh[stop]) < TOGETHER):
                held += len(fresh[stop])
                stop += 1
            some = fresh[at:stop] if self.by_words else [fresh[at]]
            for w, entry in zip(some, self._entries(some), strict=True):
                found[w] = entry
                if len(w) <= LONGEST:
                    known = hash(w)
                    if known in once:
                        self._remember(w, entry)
                    once.add(known)
            at += len(some)
        return found

    def documents(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """(tokens a, tokens b, groups, their text, distinct linked pairs, how often) of whole texts."""
        self._built  # noqa: B018
        split = [self.words(t) if t else [] for t in texts]
        entries = self.learned(set(chain.from_iterable(split)))
        found = []
        for words in split:
            own = [entries[w] for w in words]
            if not own or None in own:
                found.append(NOTHING)
                continue
            a, b, n, text, pairs = zip(*own, strict=True)
            found.append((sum(a), sum(b), sum(n), ";".join(text), *_counted(np.fromiter(chain.from_iterable(pairs), np.int64))))
        return found

    def _remember(self, word: str, entry: tuple | None) -> None:
        if len(self.known) >= REMEMBERED:
            self.known, self.before = {}, self.known
        self.known[word] = entry

    def _plain(self, words: list[str], base: int, start: int, stop: int) -> Fragment | None:
        """The fragment of a few words, token by token."""
        run = self.tokens(words)
        if run is None:
            return None
        sides = []
        for ids, ends in ((run.a, run.a_ends + base), (run.b, run.b_ends + base)):
            mine = (ends > start) & (ends <= stop)
            sides += [ids[mine], ends[mine]]
        a, a_ends, b, b_ends = sides
        _, common = _merged(a_ends, b_ends)
        cut_a, cut_b = (np.searchsorted(e, common, "right").tolist() for e in (a_ends, b_ends))
        runs = [
            Run(a[i:j], a_ends[i:j], b[k:m], b_ends[k:m])
            for i, j, k, m in zip([0, *cut_a], [*cut_a, len(a)], [0, *cut_b], [*cut_b, len(b)], strict=True)
        ]
        if not len(common):
            return Fragment(len(a), len(b), runs[0], None, NO_TOKENS)
        closed = _joined([EMPTY_CLOSED, *map(lambda r: group(r, len(self.b_bytes)), runs[1:-1])])
        return Fragment(len(a), len(b), runs[0], closed, runs[-1])

    def fragment(self, text: str, base: int, start: int, stop: int) -> Fragment | None:
        """The fragment of the bytes from ``start`` to ``stop``. ``text`` holds the words they lie in,
        the first one's blank left out, which is byte ``base``. None where tokens do not give back bytes.

        Only the outer words are looked at token by token; a word between ends in a common end, and its
        groups are those of its entry."""
        self._built  # noqa: B018
        words = self.words(text)
        if len(words) < 4:
            return self._plain(words, base, start, stop)
        inner = words[2:-1]
        entries = self.learned(set(inner))
        head = self._plain(words[:2], base, start, stop)
        tail = self._plain(words[-1:], base + len(text.encode()) - len(words[-1].encode()), start, stop)
        own = [entries[w] for w in inner]
        if head is None or tail is None or None in own:
            return None
        a, b, n, texts, pairs = zip(*own, strict=True)
        closed = Closed(sum(n), ";".join(texts), *_counted(np.fromiter(chain.from_iterable(pairs), np.int64)))
        head = Fragment(head.n_a + sum(a), head.n_b + sum(b), head.prefix, _joined([head.closed, closed]), NO_TOKENS)
        return composed([head, tail], len(self.b_bytes))


def group(run: Run, size_b: int) -> Closed:
    """An open run that turned out to be a group."""
    ends, _ = _merged(run.a_ends, run.b_ends)
    pairs = run.a[np.searchsorted(run.a_ends, ends)] * size_b + run.b[np.searchsorted(run.b_ends, ends)]
    text = ",".join(map(str, run.a.tolist())) + "|" + ",".join(map(str, run.b.tolist()))
    return Closed(1, text, *_counted(pairs))


def composed(fragments: Iterable[Fragment | None], size_b: int) -> Fragment | None:
    """One fragment of neighbours, in their order."""
    closed, n_a, n_b = [], 0, 0
    prefix, suffix, seen = NO_TOKENS, NO_TOKENS, False
    for now in fragments:
        if now is None:
            return None
        n_a, n_b = n_a + now.n_a, n_b + now.n_b
        if now.closed is None:
            if seen:
                suffix = suffix + now.prefix
            else:
                prefix = prefix + now.prefix
            continue
        if seen:
            closed.append(group(suffix + now.prefix, size_b))
        else:
            prefix, seen = prefix + now.prefix, True
        closed.append(now.closed)
        suffix = now.suffix
    return Fragment(n_a, n_b, prefix, _joined(closed) if seen else None, suffix)


def whole(fragment: Fragment | None, size_b: int) -> tuple[int, int, Closed] | None:
    """Tokens and groups of a document; its start is a border too, so its prefix is a group."""
    if fragment is None or fragment.closed is None:
        return None
    return fragment.n_a, fragment.n_b, _joined([group(fragment.prefix, size_b), fragment.closed])


def _merged(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of either, and of both, of two rising rows of numbers."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    twice = both[1:] == both[:-1]
    return both[np.concatenate([[True], ~twice])] if len(both) else both, both[1:][twice]


def _counted(pairs: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, smallest first, and how often each came."""
    if times is None:
        return np.unique(pairs, return_counts=True)
    distinct, place = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, place, times)
    return distinct, sums


def _joined(parts: list[Closed]) -> Closed:
    pairs, times = (np.concatenate([getattr(p, name) for p in parts]) for name in ("pairs", "times"))
    return Closed(sum(p.n for p in parts), ";".join(p.text for p in parts if p.n), *_counted(pairs, times))


def _lists(rows: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else NONE
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def _columns(keys: Iterable[int], found: list[tuple[int, int, int, str, np.ndarray, np.ndarray]]) -> dict[str, object]:
    return {
        "key": list(keys), "n_a": [f[0] for f in found], "n_b": [f[1] for f in found], "n_groups": [f[2] for f in found],
        "n_links": [f[0] + f[1] - f[2] for f in found], "groups": [f[3] for f in found],
        "pairs": _lists([f[4] for f in found], np.int64), "times": _lists([f[5] for f in found], np.int32),
    }


def _short(docs: DataFrame, shipped: Broadcast) -> DataFrame:
    """Documents that a task takes whole: id, text."""
    number = [0]

    def work(rows: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        model = shipped.value
        found, at = [], 0
        while at < len(texts):
            stop, held = at, 0
            while stop < len(texts) and (stop == at or held + len(texts[stop]) < 10 * TOGETHER):
                held += len(texts[stop])
                stop += 1
            found += model.documents(texts[at:stop])
            at = stop
        first = (TaskContext.get().partitionId() << 33) + number[0]
        number[0] += len(texts)
        return {"id": rows.column(0), **_columns(range(first, first + len(texts)), found)}

    return map_text(docs, "text", "id long, " + MADE, work, [], lambda: shipped.value.forget())


def ranges(text: str, size: int, by_words: bool = True) -> list[tuple[int, int, int, int]]:
    """(start, stop, from, to) of ranges of about ``size`` characters that cover a text: characters
    ``start`` to ``stop`` lie in the words between ``from`` and ``to``. A range ends anywhere, but for
    runs of more than ``size`` characters without a border, which stay in one range."""
    cuts = []
    for at in range(size, len(text), size) if by_words else ():
        after = BORDER.search(text, at)
        before = text.rfind(" ", 0, at)
        while before > max(at - size, 0) and not BORDER.match(text, before):
            before = text.rfind(" ", 0, before)
        if after and before > at - size and BORDER.match(text, before) and after.start() - before <= size:
            cuts.append((at, before, after.start()))
    starts = [(0, 0), *((at, before + 1) for at, before, _ in cuts)]
    stops = [*((at, after) for at, _, after in cuts), (len(text), len(text))]
    return [(a, b, x, y) for (a, x), (b, y) in zip(starts, stops, strict=True)]


def _fragments(docs: DataFrame, shipped: Broadcast, size: int) -> DataFrame:
    """(key, id, part, parts, body) of long documents, a row for each range."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number = shipped.value, 0
        model._built  # noqa: B018
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text, number = text.as_py(), number + 1
                found = ranges(text, size, model.by_words)
                key = -((TaskContext.get().partitionId() << 33) + number)
                at, byte = 0, 1  # a blank stands before the text
                for part, (start, stop, low, high) in enumerate(found):
                    byte, at = byte + len(text[at:start].encode()), start
                    first = byte if part else 0
                    last = byte + len(text[start:stop].encode())
                    base = byte - len(text[low:start].encode()) - 1
                    row = ([key], [id], [part], [len(found)], [base], [first], [last], [text[low:high]])
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=names)

    names = ["key", "id", "part", "parts", "base", "first", "last", "text"]
    kinds = [pa.int64()] * 7 + [pa.string()]
    pieces = docs.select("id", "text").mapInArrow(cut, ", ".join(f"`{n}` {'string' if n == 'text' else 'long'}" for n in names))

    def work(rows: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        model, at = shipped.value, [rows.column(i).to_pylist() for i in (4, 5, 6)]
        bodies = [packed(model.fragment(t, *where)) for t, *where in zip(texts, *at, strict=True)]
        return {n: rows.column(i) for i, n in enumerate(names[:4])} | {"body": bodies}

    dealt = pieces.repartition("key", "part")
    fields = "key long, id long, part long, parts long, body binary"
    return map_text(dealt, "text", fields, work, [], lambda: shipped.value.forget())


def _composed(fragments: DataFrame, size_b: int, fan: int) -> DataFrame:
    """A row per document of its fragments, composed as a tree."""

    def fold(parts: pa.Array) -> Fragment | None:
        return composed((unpacked(p["body"].as_py()) for p in parts), size_b)

    def one_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [packed(fold(parts)) for parts in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bodies, pa.binary())], names=["key", "id", "part", "body"])

    def last_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for parts in batch.column(3):
                n_a, n_b, c = whole(fold(parts), size_b) or (0, 0, EMPTY_CLOSED)
                found.append((n_a, n_b, c.n, c.text, c.pairs, c.times))
            columns = {"id": batch.column(1), **_columns(batch.column(0).to_pylist(), found)}
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=list(columns))

    def together(now: DataFrame) -> DataFrame:
        bodies = F.sort_array(F.collect_list(F.struct(F.col("part").alias("at"), "body"))).alias("bodies")
        some = now.groupBy("key", F.expr(f"part div {fan}").alias("part")).agg(F.max("id").alias("id"), bodies)
        return some.select("key", "id", "part", "bodies")

    most = fragments.agg(F.max("parts")).first()[0] or 1
    now = fragments.select("key", "id", "part", "body")
    while most > fan:
        now = together(now).mapInArrow(one_round, "key long, id long, part long, body binary")
        most = -(-most // fan)
    return together(now).mapInArrow(last_round, "id long, " + MADE)


def aligned(
    docs: DataFrame, pair: Pair, id: str = "doc_id", text: str = "text", folder: str | None = None, size: int = RANGE, fan: int = FAN
) -> DataFrame:
    """A row per document: id, key (a number of the row's own), n_a, n_b, n_groups, n_links, the text of
    its groups, and the distinct pairs of ids linked in it with how often (``times``)."""
    folder = folder or storage.scratch(docs.sparkSession, "align")
    plain = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > size
    shipped = ship(docs, pair)  # two tokenizer files, of fixed size
    fragments = saved(_fragments(plain.where(long), shipped, size), folder, "fragments")
    return _short(plain.where(~long), shipped).unionByName(_composed(fragments, pair.size_b, fan))


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


def counted(found: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold each pair of ids."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def given() -> pa.RecordBatch:
            pairs, times = _counted(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
            held[:] = [(pairs, times)]
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])

        for batch in batches:
            (pairs, _), (times, _) = (_arrays(c) for c in batch.columns)
            held.append((pairs, times.astype(np.int64)))
            size += len(pairs)
            if size > 4 * HELD:
                now = given()
                size = now.num_rows
                if size > HELD:
                    yield now
                    held.clear()
                    size = 0
        if held:
            yield given()

    partial = found.select("pairs", "times").mapInArrow(sums, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def scored(found: DataFrame, size_b: int, folder: str, often: int = OFTEN) -> DataFrame:
    """``found`` (as ``aligned`` gives it, written to a table) with n_best and count_sum, without its pairs.

    n_best: links whose pair has the largest count of all with the same second id, ties included.
    count_sum: the sum over links of their pair's count.
    """
    counts = saved(counted(found), folder, "counts")
    best = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    # one row for each id of the second tokenizer at most
    marked = counts.join(F.broadcast(best), F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # counts in steps of an eighth of a power of two: as many steps from the top as hold at most ``often`` pairs
    step = F.floor(F.log2("n") * 8)
    least, held = None, 0
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += row["count"]
        if held > often:
            break
        least = row["step"]
    common = marked.where(step >= least if least is not None else F.lit(False)).toArrow().sort_by("pair")
    table = tuple(common.column(c).to_numpy() for c in ("pair", "n", "best"))
    shipped = ship(found, table)

    def look_up(batches: Iterator[pa.RecordBatch], rare: bool) -> Iterator[pa.RecordBatch]:
        known, n, is_best = shipped.value
        for batch in batches:
            (pairs, sizes), (times, _) = _arrays(batch.column(1)), _arrays(batch.column(2))
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            if rare:
                rows = np.repeat(batch.column(0).to_numpy(), sizes)
                columns = [rows[~hit], pairs[~hit], times[~hit].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "pair", "times"])
                continue
            times = np.where(hit, times, 0).astype(np.int64)
            values = (times * is_best[place], times * n[place]) if len(known) else (times, times)
            ends = np.cumsum(sizes)
            totals = [np.concatenate([[0], np.cumsum(v)]) for v in values]
            sums = [t[ends] - t[ends - sizes] for t in totals]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums)], names=["key", "n_best", "count_sum"])

    # the other columns come along in the same pass
    kept = [c for c in found.columns if c not in ("pairs", "times", "key")]

    def with_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = next(look_up(iter([batch.select(["key", "pairs", "times"])]), False))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*made.columns, *columns], names=["key", "n_best", "count_sum", *kept])

    types = dict(found.dtypes)
    schema = "key long, n_best long, count_sum long, " + ", ".join(f"`{c}` {types[c]}" for c in kept)
    made = found.mapInArrow(with_sums, schema)
    rest = marked.where(step < least if least is not None else F.lit(True))
    if held > often:
        misses = found.select("key", "pairs", "times").mapInArrow(lambda b: look_up(b, True), "key long, pair long, times long")
        sums = misses.join(rest, "pair").groupBy("key").agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
        )
        made = made.join(sums, "key", "left").select(
            (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), *kept,
        )
    return made.select(*kept, "n_best", "count_sum")


def public(first: str | None = None, second: str | None = None) -> Pair:
    """The tokenizers at two paths on the driver, by default the installed byte-level and piece ones."""
    if first is None or second is None:
        import public_tokenizers

        first = first or public_tokenizers.path("byte_bpe_50k.json")
        second = second or public_tokenizers.path("piece_bpe_32k.model")
    with open(first, encoding="utf-8") as one, open(second, "rb") as two:
        return Pair(one.read(), two.read())
