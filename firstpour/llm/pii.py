"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Spans of four kinds are found by fixed patterns and always stay. Looser patterns propose further
spans of these and two more kinds. Six labelers vote on each proposal: pattern, checksum, the words
before it, a gazetteer, its shape, what touches it. Their votes, with a few coarse features of the
span, are counted over all texts. From these counts, whose number is bounded by the features and not
by the data, expectation-maximisation estimates per kind how reliable each labeler is, and a logistic
regression on votes and features is trained on the resulting probabilities. Proposals it accepts that
touch no span found so far are added.

Whole texts are read. Null texts count as empty and have no spans. Positions are code points, ends
exclusive. Rows are independent: repeated rows get repeated results, an empty table gives none and a
classifier that adds nothing. Other columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NEEDED = re.compile("[0-9@]")
#: As given, but that a run of digits is tried once, from its start: later starts fail alike.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Looser patterns, for proposals.
LOOSE = {
    "ip": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "phone": re.compile(r"(?<![\w.+-])\(?[0-9]{2,4}\)?[ ./-]?[0-9]{3,4}[ ./-][0-9]{3,4}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
}
BREAKS = frozenset(" \t\n\r\v\f@<>()[]{},;:\"'|")
#: Words that speak for or against personal data when they stand shortly before it.
FOR = {
    "email": ("mail", "contact", "write to", "reach"),
    "ip": ("ip", "address", "host", "client", "from"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "credit", "debit"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "contact", "whatsapp"),
    "ssn": ("ssn", "social security", "tax id"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
AGAINST = ("version", "isbn", "issn", "order", "invoice", "ticket", "serial", "sku", "page", "pages", "rfc", "section", "doi")
#: Gazetteers: ends of domain names, calling codes, first digits of card issuers, countries of account numbers.
ENDS = frozenset("com org net edu gov int mil info biz io de fr es it uk us ca nl be at ch pl se no dk fi pt ie eu ru jp cn in au br mx".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "2221", "2720")
COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE".split())


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _at_signs(text: str) -> Iterator[int]:
    at = text.find("@")
    while at >= 0:
        yield at
        at = text.find("@", at + 1)


def fixed(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns: leftmost, not overlapping within a kind."""
    found: list[tuple[str, int, int]] = []
    if not NEEDED.search(text):
        return found
    end = 0
    for at in _at_signs(text):
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and at >= end and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append(("email", start, end))
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans of the looser patterns."""
    found: list[tuple[str, int, int]] = []
    if not NEEDED.search(text):
        return found
    for at in _at_signs(text):
        start, end = at, at + 1
        # From break to break, however long; an @ is one too, so each character is seen twice at most.
        while start and text[start - 1] not in BREAKS:
            start -= 1
        while end < len(text) and text[end] not in BREAKS:
            end += 1
        if start < at and end > at + 1:
            found.append(("email", start, end))
    for m in CARD.finditer(text):
        if 13 <= len(_digits(m[0])) <= 19:
            found.append(("card", *m.span()))
    for kind, pattern in LOOSE.items():
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def _checksum(kind: str, body: str, digits: str) -> int:
    if kind == "card":
        return 1 if luhn(digits) else -1
    if kind == "iban":
        plain = body.replace(" ", "")
        turned = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if int(turned) % 97 == 1 else -1
    if kind == "ssn":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 0
    return 0


def _gazetteer(kind: str, body: str, digits: str) -> int:
    if kind == "email":
        return 1 if body.rpartition("@")[2].strip(".!?").rpartition(".")[2].lower() in ENDS else -1
    if kind == "phone":
        return 1 if digits.startswith("00") and digits[2:].startswith(CALLING) else 0
    if kind == "card":
        return 1 if digits.startswith(ISSUERS) else -1
    if kind == "iban":
        return 1 if body[:2] in COUNTRIES else -1
    return 0


def described(text: str, span: tuple[str, int, int]) -> tuple[int, ...]:
    """What is known of a proposal: its kind, six votes (-1, 0, 1) and four coarse features."""
    kind, start, end = span
    body, before = text[start:end], text[max(0, start - 32) : start].lower()
    digits = _digits(body)
    left, right = text[start - 1 : start], text[end : end + 1]
    if kind == "email":
        strict = 1 if DOMAIN.fullmatch(body.rpartition("@")[2]) else -1
        shape = 1 if body.count("@") == 1 and body[0].isalnum() and "." in body.rpartition("@")[2].strip(".") else -1
    elif kind == "ip":
        strict = 1 if body.count(":") == 7 or body.count("::") == 1 else -1
        shape = 1 if any(c in "abcdefABCDEF" for c in body) else -1
    elif kind == "card":
        strict = 1 if 14 <= len(digits) <= 19 else -1
        shape = 1 if re.fullmatch(r"(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", body) else -1 if len(set(digits)) < 4 else 0
    elif kind == "phone":
        strict = 1 if 9 <= len(digits) <= 12 else -1
        shape = 1 if "(" in body and ")" in body or re.fullmatch(r"[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}", body) else -1 if "/" in body else 0
    else:
        strict, shape = 1, 0 if kind == "ssn" else (1 if " " in body or len(body) > 14 else -1)
    words = 1 if any(w in before for w in FOR[kind]) else -1 if any(w in before for w in AGAINST) else 0
    touch = -1 if left.isalnum() or right.isalnum() or left in tuple("/#=_") or right in tuple("/=_%") else 0
    votes = (strict, _checksum(kind, body, digits), words, _gazetteer(kind, body, digits), shape, touch)
    apart = 0 if body.isalnum() else 1 if " " in body else 2 if "-" in body else 3
    side = lambda c: 0 if not c else 1 if c.isspace() else 2
    return (KINDS.index(kind), *votes, min(len(digits) // 3, 6), apart, side(left), side(right))


#: Values of each entry of a description: at most 6 * 3**6 * 7 * 4 * 9 of them differ, whatever the data.
VOTES, SIZES = 6, (len(KINDS), 3, 3, 3, 3, 3, 3, 7, 4, 3, 3)


@dataclass
class SpanModel:
    """Reliability of the labelers per kind, as (rate of votes for, against) given yes and no, and the classifier."""

    reliability: dict[str, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray | None = None

    @staticmethod
    def features(rows: np.ndarray) -> np.ndarray:
        """One-hot values, the votes' once more for each kind."""
        parts = [np.ones((len(rows), 1))]
        for i, size in enumerate(SIZES):
            value = rows[:, i] + (1 if 1 <= i <= VOTES else 0)
            parts.append(np.eye(size)[value])
            if 1 <= i <= VOTES:
                parts.append(np.eye(size * len(KINDS))[rows[:, 0] * size + value])
        return np.concatenate(parts, axis=1)

    @classmethod
    def fit(cls, rows: np.ndarray, counts: np.ndarray, rounds: int = 60) -> SpanModel:
        model = cls()
        if not len(rows):
            return model
        target = np.zeros(len(rows))
        for k, kind in enumerate(KINDS):
            own = np.flatnonzero(rows[:, 0] == k)
            if len(own):
                target[own], model.reliability[kind] = _em(rows[own, 1 : VOTES + 1], counts[own], rounds)
        x, w = cls.features(rows), counts / counts.sum()
        beta = np.zeros(x.shape[1])
        for _ in range(30):  # Newton steps of a ridge logistic regression
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            curve = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(beta))
            step = np.linalg.solve(curve, x.T @ (w * (target - p)) - 1e-4 * beta)
            beta += step
            if np.abs(step).max() < 1e-6:
                break
        model.weights = beta
        return model

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(rows))
        return 1 / (1 + np.exp(-np.clip(self.features(rows) @ self.weights, -30, 30)))


def _em(votes: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of yes per row of votes, and the labelers' rates of each vote given no and yes.

    Labelers are taken as independent given the answer. They start out better than chance, and the
    smoothing keeps them away from certainty.
    """
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # rows, labelers, vote
    p = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1)))
    for _ in range(rounds):
        yes = (counts * p)[:, None, None]
        no = (counts * (1 - p))[:, None, None]
        prior = np.array([[0.5, 1.0, 0.1], [0.1, 1.0, 0.5]])[:, None, :]
        rates = np.stack([(hot * no).sum(axis=0), (hot * yes).sum(axis=0)]) + prior
        rates /= rates.sum(axis=2, keepdims=True)
        share = ((counts * p).sum() + 1) / (counts.sum() + 2)
        logs = [np.log(s) + (hot * np.log(r)).sum(axis=(1, 2)) for s, r in ((1 - share, rates[0]), (share, rates[1]))]
        p = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
    return p, rates


def learn(docs: DataFrame, text: str = "text") -> SpanModel:
    """The model for a table: counts of proposals by description over all its texts, then EM and training."""
    width = len(SIZES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    taken = [(a, b) for _, a, b in fixed(t)]
                    seen.update(described(t, s) for s in proposals(t) if _free(s, taken))
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(k) for k in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], names=["row", "n"]
        )

    counted = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    rows = counted.mapInArrow(work, "row array<int>, n long").groupBy("row").agg(F.sum("n").alias("n")).collect()
    rows.sort()
    return SpanModel.fit(np.array([r[0] for r in rows], int).reshape(-1, width), np.array([r[1] for r in rows], float))


def _free(span: tuple[str, int, int], taken: list[tuple[int, int]]) -> bool:
    return all(span[2] <= a or span[1] >= b for a, b in taken)


def spans(text: str, model: SpanModel, least: float = 0.5) -> list[tuple[str, int, int, bool, float]]:
    """All spans of a text: kind, start, end, whether of a fixed pattern, score."""
    sure = fixed(text)
    found = [(*s, True, 1.0) for s in sure]
    taken = [(a, b) for _, a, b in sure]
    offered = [s for s in proposals(text) if _free(s, taken)]
    if offered:
        scores = model.score(np.array([described(text, s) for s in offered]))
        for s, score in sorted(zip(offered, scores, strict=True), key=lambda x: (-x[1], x[0][1], x[0][2])):
            if score >= least and _free(s, taken):
                found.append((*s, False, float(score)))
                taken.append((s[1], s[2]))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,fixed:boolean,score:double>>"


def find(docs: DataFrame, model: SpanModel, text: str = "text", into: str = "spans", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the spans of each whole text."""
    shipped = ship(docs, model)
    names = ("kind", "start", "end", "fixed", "score")

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        return {into: [[dict(zip(names, s, strict=True)) for s in spans(t, shipped.value)] for t in texts]}

    return map_text(docs, text, f"`{into}` {SPANS}", work, keep)


def redact(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """``docs`` with each span of a text replaced by its kind, as in ``<EMAIL>``; null texts stay null."""
    shipped = ship(docs, model)

    def work(rows: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        null = rows.column(rows.schema.get_field_index(text)).is_null().to_pylist()
        return {text: [None if gone else masked(t, spans(t, shipped.value)) for t, gone in zip(texts, null, strict=True)]}

    return map_text(docs, text, f"`{text}` string", work).select(*[F.col(f"`{c}`") for c in docs.columns])


def masked(text: str, found: list[tuple[str, int, int, bool, float]]) -> str:
    out, at = [], 0
    for kind, start, end, *_ in found:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
