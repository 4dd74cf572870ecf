import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from firstpour.llm import bpe, registry
from tests.conftest import SF
from tests.llm.helpers import documents, edges


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def own():
    return bpe.public()


def same(own, library, text):
    expected = library.encode(text, add_special_tokens=False)
    found = np.frombuffer(own.encode(text), np.int32)
    return found.tolist() == expected.ids and own.decode(found) == library.decode(expected.ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "\x1c a\x1db", "<|startoftext|>x<|endoftext|><|startoftext|", "Σας ΑΣ", "İstanbul", "é́é", "a" * 400, "a</w> b",
     "日本語テキスト", "'s't'LL", "\x00\xa0 x", "😀👍🏽 ok", "½ⅷ١٢", "!!!!!???", "x՘y"],
)
def test_odd_texts_like_the_library(own, library, text):
    assert same(own, library, text)


def test_random_texts_like_the_library(own, library):
    draw = random.Random(1)
    for letters in ("abcdeéüñ .,!'<|>/w09日́\n\t\x1c\x85ß😀ΣAİZ", "abthein sr"):
        for _ in range(2000):
            assert same(own, library, "".join(draw.choice(letters) for _ in range(draw.randint(1, 50))))


def test_one_pass_finds_every_match(own):
    own.encode("x")
    ids = {symbols: token for token, symbols in own.symbol.items()}
    draw = random.Random(6)
    for word in ["interesting", "\xff" * 30, *("".join(draw.choice("abthein") for _ in range(40)) for _ in range(200))]:
        word = word[:-1] + chr(ord(word[-1]) + 256)
        for place, token in enumerate(own._matches(word)):
            cuts = [word[place : place + n] for n in range(1, len(word) - place + 1)]
            assert own._starts(token) == [(len(c), ids[c]) for c in cuts if c in ids]


def test_single_symbols_need_no_automaton(own, library, monkeypatch):
    own.encode("x")
    assert all(len(own.symbol[token]) > 1 for _, token in own.automaton.values())
    assert all(own._matches(chr(c)) == [own.single[c]] for c in range(512))
    monkeypatch.setattr(bpe, "AT_ONCE", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    draw = random.Random(9)
    assert same(own, library, " ".join("x" * draw.randint(1, 60) + draw.choice("abc") for _ in range(300)))


def test_query_like_the_library(spark, library):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = {r["doc_id"]: tuple(r)[1:] for r in registry.op10_bpe(spark, SF).collect()}
    for i, text in documents(SF):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i] == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))


def test_edges_and_decoding(spark, own):
    coded = bpe.encode(edges(spark), own, decoded="decoded")
    rows = bpe.decode(coded, own, decoded="again").collect()
    assert len(rows) == 12 and all(r["decoded"] == r["again"] for r in rows)
    assert [len(r["ids"]) for r in rows if not (r["text"] or "").strip()] == [0, 0, 0, 0]
    assert bpe.encode(edges(spark).limit(0), own).count() == 0
