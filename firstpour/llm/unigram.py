"""Token counts under a unigram vocabulary, worked out once per shared prefix of distinct pre-tokens.

Pre-tokens are words with the blanks before them. The distinct ones of a run of texts form a trie,
which is walked in order; the best score of every way to cut a prefix into pieces is kept on the
path, so a pre-token only pays for what follows the prefix it shares with the one before. At its end
the number of pieces of the best way is stored as its count, and a text's count is the sum over its
pre-tokens. Among equal scores the longer last piece wins. Characters that no piece covers count as
their bytes.

Whole texts are read. Null texts count as empty and have no tokens. Rows are independent: repeated
rows get repeated counts, an empty table gives none. Other columns stay as they are.
"""

from __future__ import annotations

import re
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from firstpour.llm.tasks import map_text, ship

BLANK = "▁"
#: What an unknown character costs below the lowest score.
UNKNOWN = 10.0
#: Pre-tokens whose counts a task remembers; beyond it the memory is emptied, results stay the same.
REMEMBERED = 1_000_000


class Unigram:
    """Pieces and their scores; of fixed size, whatever the texts."""

    def __init__(self, pieces: dict[str, float], prefix: bool = True):
        across = [p for p in pieces if BLANK in p.lstrip(BLANK)]
        if across:
            raise ValueError(f"pieces that go on after a blank: {across[:5]}")
        self.pieces, self.prefix = pieces, prefix
        # blanks before a word belong to it; line ends and tabs stand alone unless longer pieces hold them
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in pieces if len(p) > 1))
        self.pretoken = re.compile(rf"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" + (f"|[{alone}]" if alone else ""))

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "prefix": self.prefix, "pretoken": self.pretoken}

    @classmethod
    def read(cls, path: str) -> Unigram:
        """The ordinary pieces of a model file, on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})

    @cached_property
    def _trie(self) -> dict:
        root: dict = {}
        for piece, score in self.pieces.items():
            node = root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        return root

    @cached_property
    def _counts(self) -> dict[str, int]:
        return {}

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of each text."""
        cut = [self.pretoken.findall((BLANK if self.prefix and t else "") + t.replace(" ", BLANK)) for t in texts]
        known = self._counts
        if len(known) > REMEMBERED:
            known.clear()
        new: set[str] = set()
        for own in cut:
            new.update(own)
        new.difference_update(known)
        self._walk(sorted(new))
        return [(len(own), sum(map(known.__getitem__, own))) for own in cut]

    def _walk(self, ordered: list[str]) -> None:
        """Stores the counts of pre-tokens given in order, as a walk over their trie."""
        root, known = self._trie, self._counts
        unknown = min(self.pieces.values(), default=0.0) - UNKNOWN
        # for each prefix of the path: its best score, its pieces, and the pieces begun but not ended there
        score, count, begun = [0.0], [0], [[]]
        before = ""
        for word in ordered:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :], begun[shared + 1 :]
            for at in range(shared, len(word)):
                c = word[at]
                best, pieces, still = None, 0, []
                for start, node in begun[at]:
                    node = node.get(c)
                    if node is not None:
                        still.append((start, node))
                        value = node.get("")
                        if value is not None and (best is None or score[start] + value > best):
                            best, pieces = score[start] + value, count[start] + 1
                node = root.get(c)
                value = None
                if node is not None:
                    still.append((at, node))
                    value = node.get("")
                if value is not None:
                    if best is None or score[at] + value > best:
                        best, pieces = score[at] + value, count[at] + 1
                elif best is None or score[at] + unknown > best:
                    best, pieces = score[at] + unknown, count[at] + len(c.encode("utf-8", "replace"))
                score.append(best)
                count.append(pieces)
                begun.append(still)
            known[word] = count[-1]
            before = word


def public(path: str | None = None) -> Unigram:
    """The vocabulary at ``path`` on the driver, by default the installed one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Unigram.read(path)


def token_counts(
    docs: DataFrame, vocabulary: Unigram, text: str = "text", tokens: str = "n_tokens", pretokens: str = "n_pretokens", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with the number of pre-tokens and tokens of each whole text."""
    shipped = ship(docs, vocabulary)

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        found = shipped.value.count(texts)
        return {pretokens: [f[0] for f in found], tokens: [f[1] for f in found]}

    return map_text(docs, text, f"`{pretokens}` long, `{tokens}` long", work, keep)
