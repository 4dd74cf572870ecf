import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firstpour import storage
from firstpour.llm import align, registry
from firstpour.llm.bpe import _byte_letters
from tests.conftest import SF
from tests.llm.helpers import documents, edges


@pytest.fixture(scope="module")
def pair():
    return align.public()


class Brute:
    """Whole texts by the libraries, every pair of tokens looked at."""

    def __init__(self):
        self.one = Tokenizer.from_file(path("byte_bpe_50k.json"))
        self.one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        self.byte = {c: i for i, c in enumerate(_byte_letters())}

    def document(self, text):
        """Groups and links of a text, or None without tokens."""
        if not text:
            return None
        a, b = self.one.encode(" " + text, add_special_tokens=False).ids, self.two.encode(text)
        a_bytes = [bytes(self.byte[c] for c in self.one.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.two.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, self.two.id_to_piece(b))]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        spans = []
        for tokens in (a_bytes, b_bytes):
            at, own = 0, []
            for t in tokens:
                own.append((at, at + len(t)))
                at += len(t)
            spans.append(own)
        links, first = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, i, j = [], 0, 0
        for end in ends:
            x, y = i, j
            while i < len(a) and spans[0][i][1] <= end:
                i += 1
            while j < len(b) and spans[1][j][1] <= end:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        return len(a), len(b), groups, links

    def table(self, rows):
        found = [(i, self.document(t)) for i, t in rows]
        counts = Counter(link for _, d in found if d for link in d[3])
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for i, d in found:
            if d is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = d
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((i, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
        return sorted(out, key=repr)


ODD = ["a  b\tc\n d", " lead", "trail ", "x▁y", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 テキスト", "é😀👍🏽 ok", "don't 'll !'s", "\x00 a", "a b c",
       "\x1c x \x1d", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567 89", "naïve café", " ", "\n", "tab\t tab", "é x", "!!! ??? ...", "ﬁ Å", " em space"]


def digested(spark, docs, pair, **options):
    folder = storage.scratch(spark, "test")
    often = options.pop("often", align.OFTEN)
    found = align.aligned(docs, pair, folder=folder, **options)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("sha")
    found = align.saved(found.select("id", "key", "n_a", "n_b", "n_groups", "n_links", "pairs", "times", digest), folder, "found")
    return sorted((tuple(r) for r in align.scored(found, pair.size_b, folder, often).select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha").collect()), key=repr)


def test_query_like_brute_force(spark):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in registry.op12_align(spark, SF).select(*columns).collect()), key=repr) == Brute().table(documents(SF))


@pytest.mark.parametrize(("size", "fan", "often"), [(32_768, 16, 262_144), (40, 2, 50), (7, 3, 0), (1000, 16, 5)])
def test_ranges_and_rare_pairs_change_nothing(spark, pair, size, fan, often):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "", *(t for _, t in documents(SF)[:25])])] + [(None, "no id " * 30), (3, "x▁y"), (9, "again and again " * 9), (9, "again and again " * 9)]
    assert digested(spark, edges(spark, rows), pair, size=size, fan=fan, often=often) == Brute().table(rows)


def test_random_texts(pair):
    draw, brute = random.Random(8), Brute()
    pair.size_b  # noqa: B018
    for letters in ("ab \n\té'1!", "the quick b ", " \x1c  x."):
        for _ in range(400):
            text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 40)))
            expected = brute.document(text)
            size = draw.randint(1, 12)
            parts, at = [], [1 + len(text[:c].encode()) for c in range(len(text) + 1)]
            for k, (start, stop, low, high) in enumerate(align.ranges(text, size)):
                parts.append(pair.fragment(text[low:high], at[low] - 1, at[start] if k else 0, at[stop]))
            # in any bracketing
            while len(parts) > 1:
                k = draw.randrange(len(parts) - 1)
                parts[k : k + 2] = [align.composed(parts[k : k + 2], pair.size_b)]
            whole = align.whole(parts[0], pair.size_b)
            assert (whole is None) == (expected is None)
            if whole:
                n_a, n_b, closed = whole
                assert (n_a, n_b, closed.text) == (expected[0], expected[1], ";".join(expected[2]))
                assert Counter((p // pair.size_b, p % pair.size_b) for p in closed.pairs.repeat(closed.times).tolist()) == Counter(expected[3])


def test_both_encoders_give_the_same_ids(pair):
    pair.size_b  # noqa: B018
    draw, letters = random.Random(12), "ab1'!sé日٣² \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2003\u2028\u200b\u3000\ufeff"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 30))) for _ in range(5000)]
    points = [chr(c) for c in range(1, 0x110000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts += [" ".join(f"a{c}1{c} {c}" for c in points[i : i + 100]) for i in range(0, len(points), 100)]
    for text in texts:
        assert pair.quick.encode_ordinary(text) == pair.one.encode(text, add_special_tokens=False).ids


def test_no_bytes_change_nothing(pair):
    some = pair.fragment("some words here", 0, 3, 9)
    for parts in ([align.EMPTY, some], [some, align.EMPTY], [some]):
        assert repr(align.composed(parts, pair.size_b)) == repr(some)
    assert align.composed([some, None], pair.size_b) is None


def test_very_long_texts_are_cut_and_a_long_run_stays_whole(spark, pair):
    found = align.ranges("word " * 400_000, 32_768)
    assert len(found) == 62 and all(high - low < 33_000 for _, _, low, high in found)
    assert len(align.ranges("x" * 100_000 + " y", 1000)) == 1
    texts = [(1, "some words and more " * 20_000), (2, "x1" * 60_000), (3, None)]
    assert digested(spark, edges(spark, texts), pair) == Brute().table(texts)
    assert digested(spark, edges(spark, texts).limit(0), pair) == []
