"""BPE encoding by backtracking over longest token matches, and decoding through an offset table.

A word is a sequence of symbols: its bytes, the last one marked as word end. Aho-Corasick finds every
token in the word at once. The encoder takes the longest token at each place; where two neighbours
would have merged across their border it falls back to the next shorter token, or gives up the place
and goes back one token. A place given up is never tried again, so the work grows with the word's
length. The tokens that remain are those of the merges applied in order.

Letters, digits and cases are those of the Python and regex versions at hand; code points that one of
them does not know yet may be split otherwise than a library with a later Unicode would.

Null texts count as empty and have no tokens. Rows are independent of each other, so repeated rows
give repeated results and an empty table gives none.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship

#: Words, parts and pairs of tokens whose results a task remembers; beyond it the memory is emptied, results stay the same.
REMEMBERED = 250_000
#: Words of a text that are looked up together.
AT_ONCE = 50_000
#: What Unicode calls white space, the runs that the normaliser turns into a blank.
SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class WordBpe:
    """A vocabulary with word ends, as a tokenizer file describes it; small enough to ship to tasks."""

    def __init__(self, spec: str):
        self.spec = spec

    def __getstate__(self) -> dict:
        return {"spec": self.spec}

    @classmethod
    def read(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    @cached_property
    def _file(self) -> dict:
        found = json.loads(self.spec)
        if found["model"]["type"] != "BPE" or found["model"].get("end_of_word_suffix") != "</w>":
            raise ValueError("a BPE vocabulary with </w> word ends is needed")
        return found

    @cached_property
    def _built(self) -> None:
        """Tokens as symbol strings, their two halves, and the automaton over all of them."""
        vocabulary, letters = self._file["model"]["vocab"], _byte_letters()
        self.symbol = {}  # token id -> its symbols; a final byte is its code plus 256
        for b, letter in enumerate(letters):
            self.symbol[vocabulary[letter]] = chr(b)
            self.symbol[vocabulary[letter + "</w>"]] = chr(b + 256)
        self.merged: dict[tuple[int, int], int] = {}  # two tokens -> rank of their merge
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> rank and halves
        for rank, merge in enumerate(self._file["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token, a, b = vocabulary[left + right] if not left.endswith("</w>") else -1, vocabulary[left], vocabulary[right]
            if token < 0:
                continue  # nothing follows a word end
            self.merged[a, b] = rank
            self.made.setdefault(token, (rank, a, b))
            self.symbol.setdefault(token, self.symbol[a] + self.symbol[b])
        self.automaton = ahocorasick.Automaton()
        self.single = [-1] * 512  # the token of each symbol alone, which needs no automaton
        for token, symbols in self.symbol.items():
            if len(symbols) > 1:
                self.automaton.add_word(symbols, (1 - len(symbols), token))
            else:
                self.single[ord(symbols)] = token
        self.automaton.make_automaton()
        self.starts: dict[int, list[tuple[int, int]]] = {}
        self.compatible: dict[int, bool] = {}
        added = sorted((t["content"] for t in self._file.get("added_tokens", [])), key=len, reverse=True)
        self.added = {t["content"]: t["id"] for t in self._file.get("added_tokens", [])}
        self.special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.split = regex.compile(self._file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        names = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()}
        texts = [(" " + names.get(i, "")).encode() for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self.__dict__.pop("_file")  # as long as what was built of it

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side would both come out of the merges whole.

        Takes the merges that made them back, latest first. The two pieces at the border at any time
        must not be a pair that merges before the next of those; of equal ranks the left one is first.
        """
        end = len(self.merged)
        p, q = left, right
        while True:
            if self.merged.get((p, q), end) < end:
                return False
            made_p, made_q = self.made.get(p), self.made.get(q)
            if made_p is None and made_q is None:
                return True
            if made_q is None or made_p is not None and made_p[0] > made_q[0]:
                end, p = made_p[0], made_p[2]
            else:
                end, q = made_q[0] + 1, made_q[1]

    def _matches(self, symbols: str) -> list[int]:
        """The longest token that starts at each place of a word, or -1, from one pass of the automaton
        over it. Every other match there is one of the token's ``_starts``."""
        longest = list(map(self.single.__getitem__, map(ord, symbols)))
        for end, (back, token) in self.automaton.iter(symbols):
            longest[end + back] = token  # a place's matches come by their ends, the longest last
        return longest

    def _starts(self, token: int) -> list[tuple[int, int]]:
        """Tokens that a token starts with, itself included, shortest first: (symbols, token)."""
        found = self.starts.get(token)
        if found is None:
            symbols = self.symbol[token] if token >= 0 else ""
            found = [(1, self.single[ord(c)]) for c in symbols[:1]]
            found += [(1 - back, match) for end, (back, match) in self.automaton.iter(symbols) if end + back == 0]
            self.starts[token] = found
        return found

    def _word(self, symbols: str) -> list[int]:
        end, starts, compatible = len(symbols), self.starts, self.compatible
        open_ = bytearray(b"\1") * (end + 1)
        tokens: list[int] = []
        trail: list[tuple[list[tuple[int, int]], int]] = []  # the matches left at each token's start
        longest = self._matches(symbols)
        place, before, matches = 0, -1, self._starts(longest[0])
        left = len(matches)
        while place < end:
            while left:
                left -= 1
                size, token = matches[left]
                if not open_[place + size]:
                    continue
                if before >= 0:
                    fits = compatible.get(before << 32 | token)
                    if not fits and (fits is not None or not self._fits(before, token)):
                        continue
                tokens.append(token)
                trail.append((matches, left))
                place += size
                before = token
                if place < end:
                    matches = starts.get(longest[place]) or self._starts(longest[place])
                    left = len(matches)
                break
            else:
                if not tokens:
                    raise ValueError("the vocabulary lacks a byte")
                open_[place] = 0
                place -= len(self.symbol[tokens.pop()])
                matches, left = trail.pop()
                before = tokens[-1] if tokens else -1
        return tokens

    def _fits(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) > REMEMBERED:
                self.compatible.clear()
            known = self.compatible[pair] = self._stay_apart(left, right)
        return known

    def forget(self) -> None:
        """Give up what was remembered of texts; results stay the same."""
        self._built  # noqa: B018
        for memory in (self.words, self.parts, self.compatible):
            memory.clear()

    def _chunk(self, chunk: str) -> bytes:
        """Token ids, as 32-bit integers, of text without white space."""
        ids: list[bytes] = []
        for piece in self.special.split(chunk) if self.special and self.special.search(chunk) else [chunk]:
            if piece in self.added:
                ids.append(array("i", [self.added[piece]]).tobytes())
            else:
                for part in self._parts(piece):
                    found = self.parts.get(part)
                    if found is None:
                        if len(self.parts) > REMEMBERED:
                            self.parts.clear()
                        raw = part.encode()
                        found = array("i", self._word(raw[:-1].decode("latin-1") + chr(raw[-1] + 256))).tobytes()
                        if len(part) < 50:
                            self.parts[part] = found
                    ids.append(found)
        return b"".join(ids)

    def _parts(self, piece: str) -> list[str]:
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        piece = piece.lower()
        if piece.isalpha():
            return [piece]
        if max(piece, default="") < "Ͱ" or all(unicodedata.category(c) != "Cn" for c in piece):
            return self.split.findall(piece)
        # code points without a meaning yet are neither letters nor digits
        shadow = "".join("‒" if unicodedata.category(c) == "Cn" else c for c in piece)
        return [piece[m.start() : m.end()] for m in self.split.finditer(shadow)]

    def encode(self, text: str) -> bytes:
        """Token ids of a text, as 32-bit integers."""
        self._built  # noqa: B018
        known, out = self.words, []
        chunks = text.split() if not ODD_SPACE.search(text) else SPACE.split(text)
        for first in range(0, len(chunks), AT_ONCE):
            part = chunks[first : first + AT_ONCE]
            if len(known) > REMEMBERED:
                known.clear()
            found = list(map(known.get, part))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        chunk = part[i]
                        found[i] = ids = known.get(chunk) or self._chunk(chunk)
                        if len(chunk) < 50:
                            known[chunk] = ids
            out += found
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens as the vocabulary names them, with a blank in between; unknown ids are left out."""
        self._built  # noqa: B018
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        if not len(ids):
            return ""
        size = self.offsets[ids + 1] - self.offsets[ids]
        end = np.cumsum(size)
        places = np.repeat(self.offsets[ids] - end + size, size) + np.arange(end[-1])
        return self.blob[places[1:]].tobytes().decode()


def _lists(rows: Iterable[bytes]) -> pa.ListArray:
    rows = list(rows)
    offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(docs: DataFrame, bpe: WordBpe, text: str = "text", ids: str = "ids", decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the token ids of each whole text, and the text decoded from them if asked for."""
    shipped = ship(docs, bpe)  # the vocabulary file, of fixed size

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        model = shipped.value
        found = [model.encode(t) for t in texts]
        made: dict[str, object] = {ids: _lists(found)}
        if decoded:
            made[decoded] = [model.decode(np.frombuffer(x, np.int32)) for x in found]
        return made

    fields = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    return map_text(docs, text, fields, work, keep, lambda: shipped.value.forget())


def decode(tokens: DataFrame, bpe: WordBpe, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the text that each row's ids stand for; null ids give an empty text."""
    shipped = ship(tokens, bpe)

    @F.pandas_udf("string")
    def texts(column):
        return column.map(lambda x: shipped.value.decode(np.array([] if x is None else x, np.int32)))

    return tokens.withColumn(decoded, texts(ids))


def public(path: str | None = None) -> WordBpe:
    """The vocabulary at ``path`` on the driver, by default the installed one with word ends."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return WordBpe.read(path)
