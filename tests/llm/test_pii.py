import hashlib
import random
import re

from firstpour.llm import pii, registry
from tests.conftest import SF
from tests.llm.helpers import documents, edges

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(k, *m.span()) for k, p in PATTERNS.items() for m in p.finditer(text) if holds(k, m[0])]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_fixed_patterns_by_brute_force():
    draw = random.Random(2)
    for _ in range(30000):
        text = "".join(draw.choice("a.@+-0123456789 ()%é") for _ in range(draw.randint(0, 40)))
        assert pii.fixed(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("0" * 200_000, "a" * 200_000 + "@", "+1" + "(" * 100_000, "1." * 100_000):
        pii.spans(text, pii.SpanModel())


def test_proposed_emails_reach_from_break_to_break():
    local, domain = "é" * 5000, "ü" * 5000 + ".org"
    assert pii.proposals(f"to <{local}@{domain}>, now") == [("email", 4, 4 + len(local) + 1 + len(domain))]
    text = "é" * 200_000 + "@" + "é@" * 200_000
    assert len(pii.proposals(text)) == 200_000


def test_query_by_brute_force(spark):
    found = {r["doc_id"]: r for r in registry.op7_pii(spark, SF).collect()}
    for i, text in documents(SF):
        expected, row = brute(text or ""), found[i]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in expected) for k in PATTERNS]
        assert set(filter(None, listed.split(","))) <= set(row["spans"].split(","))


def test_votes_add_spans_and_leave_others(spark):
    draw = random.Random(5)
    n = lambda k: "".join(draw.choice("23456789") for _ in range(k))
    good = [f"call me on ({n(3)}) {n(3)}-{n(4)} today" for _ in range(60)]
    bad = [f"order {n(3)}/{n(3)}/{n(4)}= of version {n(3)} {n(3)} {n(3)}/x" for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    model = pii.learn(docs)
    assert [s[0] for s in pii.spans("please call (234) 567-8912 now", model)] == ["phone"]
    assert pii.spans("order 234/567/8912= of", model) == []
    rates = model.reliability["phone"]
    assert rates.shape == (2, pii.VOTES, 3)


def test_edges(spark):
    docs = edges(spark, [(1, None), (2, ""), (3, "mail a.b@c.de and 1.2.3.4"), (3, "mail a.b@c.de and 1.2.3.4"), (None, "+49 (30) 1234567")])
    model = pii.learn(docs)
    assert sorted(len(r["spans"]) for r in pii.find(docs, model).collect()) == [0, 0, 1, 2, 2]
    out = pii.redact(docs, model)
    assert out.columns == docs.columns
    assert {r["text"] for r in out.collect()} == {None, "", "mail <EMAIL> and <IP>", "<PHONE>"}
    empty = docs.limit(0)
    assert pii.find(empty, pii.learn(empty)).count() == 0
