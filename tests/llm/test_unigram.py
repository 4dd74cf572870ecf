import random

from firstpour.llm import registry, unigram
from tests.conftest import SF
from tests.llm.helpers import documents, edges


def viterbi(word, pieces):
    """Tokens of the best cut; of equal ones the longer last piece, of its rest again."""
    unknown = min(pieces.values()) - unigram.UNKNOWN
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[i][0] + pieces[word[i:end]], -i, best[i][1] + 1) for i in range(end) if word[i:end] in pieces]
        if word[end - 1] not in pieces:
            options.append((best[end - 1][0] + unknown, -(end - 1), best[end - 1][1] + len(word[end - 1].encode())))
        top = max(options)
        best.append((top[0], top[2]))
    return best[-1][1]


def test_random_vocabularies_by_brute_force():
    draw = random.Random(6)
    for _ in range(60):
        pieces = {"".join(draw.choice("abcé▁") for _ in range(draw.randint(1, 4))): -float(draw.randint(0, 9)) for _ in range(12)}
        pieces = {p: s for p, s in pieces.items() if unigram.BLANK not in p.lstrip(unigram.BLANK)}
        model = unigram.Unigram(pieces)
        texts = ["".join(draw.choice("abcé \nx") for _ in range(draw.randint(0, 14))) for _ in range(20)]
        for text, (n, tokens) in zip(texts, model.count(texts), strict=True):
            own = model.pretoken.findall((unigram.BLANK if text else "") + text.replace(" ", unigram.BLANK))
            assert (n, tokens) == (len(own), sum(viterbi(w, pieces) for w in own))


def test_query_by_brute_force(spark):
    model = unigram.public()
    known: dict[str, int] = {}
    found = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in registry.op6_tokens(spark, SF).collect()}
    for i, text in documents(SF):
        own = model.pretoken.findall((unigram.BLANK if text else "") + (text or "").replace(" ", unigram.BLANK))
        for w in own:
            if w not in known:
                known[w] = viterbi(w, model.pieces)
        assert found[i] == (len(own), sum(known[w] for w in own))


def test_edges(spark):
    model = unigram.public()
    rows = unigram.token_counts(edges(spark), model).collect()
    assert len(rows) == 12 and all(r["n_tokens"] == 0 for r in rows if not r["text"])
    assert unigram.token_counts(edges(spark).limit(0), model).count() == 0
