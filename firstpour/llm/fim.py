"""Fill-in-the-middle transformation: a text's units matched once, both cuts read off the repetitions.

A text is a row of units, by default single code points. One full match of ``(unit)*`` with the regex
library, which keeps every repetition of a group, tells both how many units there are and where each
ends: ``ends(1)`` gives the number of units and the two cut offsets, and nothing goes over the text
otherwise. A repetition takes some fifty bytes while it is held, so a text longer than ``WINDOW`` is
matched in windows of that many units, of which only place and number stay; the windows that hold a
cut are matched once more. Memory beyond the text itself is therefore bounded, whatever its length.

Where to cut, and which form a document takes, comes from the first four 8-digit groups of a SHA-256
over the seed and the document's id. So a document is always cut alike, on any cluster and in any
order. The marks must not be mistakable for each other or for text: a text that holds one stays plain.

Null and empty texts have no units and stay plain, as the empty text. A row without an id is cut as if
its id were the empty text. A text that units do not cover stays plain, with the units before the place
where they end. Rows do not depend on each other: repeated rows give repeated results, an empty table
none. Other columns pass through, but those named like the new ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstpour.functions.text import quoted
from firstpour.llm.tasks import map_text, unused

#: Units matched at a time.
WINDOW = 100_000
#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """A text's units: how many, and where the first ``k`` of them end."""

    def __init__(self, unit: str = ".", window: int = WINDOW):
        self.window = window
        self.whole = regex.compile(f"({unit})*", regex.DOTALL)
        self.some = regex.compile(f"({unit}){{1,{window}}}", regex.DOTALL)

    def cut(self, text: str, draws: Sequence[int]) -> tuple[int, list[int] | None]:
        """The number of units ``n``, and the offset after ``draw % (n + 1)`` units for each draw,
        smaller ones first; no offsets where units do not cover the text."""
        if len(text) <= self.window:
            match = self.whole.fullmatch(text)
            if match is None:
                return self._windows(text)[1], None
            ends = match.ends(1)
            return len(ends), [ends[k - 1] if k else 0 for k in sorted(d % (len(ends) + 1) for d in draws)]
        windows, n, covered = self._windows(text)
        if not covered:
            return n, None
        return n, [self._end(text, windows, k) for k in sorted(d % (n + 1) for d in draws)]

    def _windows(self, text: str) -> tuple[list[tuple[int, int]], int, bool]:
        """(start, units before it) of each window, all units, and whether they cover the text."""
        windows, at, n = [], 0, 0
        while at < len(text):
            match = self.some.match(text, at)
            if match is None or match.end() == at:
                return windows, n, False
            windows.append((at, n))
            at, n = match.end(), n + len(match.starts(1))
        return windows, n, True

    def _end(self, text: str, windows: list[tuple[int, int]], k: int) -> int:
        if k == 0:
            return 0
        at, before = windows[(k - 1) // self.window]
        return self.some.match(text, at).ends(1)[k - 1 - before]


@dataclass(frozen=True)
class Forms:
    """The marks, and how many documents of a hundred take which form."""

    marks: tuple[str, str, str] = MARKS
    percent: int = 90
    spm_percent: int = 20

    def __post_init__(self) -> None:
        for i, a in enumerate(self.marks):
            for j, b in enumerate(self.marks):
                overlap = any(a.endswith(b[:k]) for k in range(1, len(b) + (i != j)))
                if not a or i != j and a in b or overlap:
                    raise ValueError("marks must be different, and none may begin within another or within itself")

    def of(self, text: str, h3: int, h4: int) -> str:
        if not text or h3 % 100 >= self.percent or any(m in text for m in self.marks):
            return "plain"
        return "spm" if h4 % 100 < self.spm_percent else "psm"

    def output(self, form: str, prefix: str, middle: str, suffix: str) -> str:
        p, s, m = self.marks
        if form == "psm":
            return f"{p}{prefix}{s}{suffix}{m}{middle}"
        return f"{s}{suffix}{p}{prefix}{m}{middle}"


def draws(id: str, seed: str = "1") -> Column:
    """Four numbers below 2^32 from the seed and a row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(quoted(id)).cast("string"), F.lit(""))), 256)
    return F.array([F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def transform(
    docs: DataFrame, id: str = "doc_id", text: str = "text", unit: str = ".", seed: str = "1", forms: Forms = Forms(),
    keep: list[str] | None = None, window: int = WINDOW,
) -> DataFrame:
    """Rows with ``n`` units, ``form`` (plain, psm or spm), the code points of prefix and middle (null
    if plain) and the ``output``. A psm output has prefix, suffix and middle in this order, an spm one
    suffix, prefix and middle, each behind its mark."""
    units = Units(unit, window)
    drawn = unused(docs, "draws")

    def work(rows: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        made: dict[str, list] = {"n": [], "form": [], "prefix_chars": [], "middle_chars": [], "output": []}
        for t, (h1, h2, h3, h4) in zip(texts, rows.column(rows.schema.get_field_index(drawn)).to_pylist(), strict=True):
            n, cuts = units.cut(t, (h1, h2))
            form = forms.of(t, h3, h4) if cuts else "plain"
            if form == "plain":
                row = (n, form, None, None, t)
            else:
                a, b = cuts
                row = (n, form, a, b - a, forms.output(form, t[:a], t[a:b], t[b:]))
            for values, value in zip(made.values(), row, strict=True):
                values.append(value)
        return made

    wanted = docs.columns if keep is None else keep
    source = docs.select(*[quoted(c) for c in dict.fromkeys([*wanted, text])], draws(id, seed).alias(drawn))
    return map_text(source, text, MADE, work, keep=list(wanted))


def restored(output: Column, form: Column, forms: Forms = Forms()) -> Column:
    """The text an output was made of, from the output and its form alone."""
    p, s, m = forms.marks
    last = F.instr(output, m)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        middle = F.instr(output, second)
        return (
            F.substr(output, F.lit(len(first) + 1), middle - len(first) - 1),
            F.substr(output, middle + len(second), last - middle - len(second)),
        )

    end = F.substr(output, last + len(m))
    psm_prefix, psm_suffix = parts(p, s)
    spm_suffix, spm_prefix = parts(s, p)
    return (
        F.when(form == "psm", F.concat(psm_prefix, end, psm_suffix))
        .when(form == "spm", F.concat(spm_prefix, end, spm_suffix))
        .otherwise(output)
    )
