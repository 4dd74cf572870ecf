import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from firstpour.llm import pii
from firstpour.llm.decontaminate import tokens
from tests.conftest import SF
from tests.llm.helpers import edges
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_minhash import brute as groups


def staged(spark, docs, sf_dir, folder):
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    texts = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    kept = groups(list(texts.items()), 5, 80)
    texts = {i: t for i, t in texts.items() if kept[i][2]}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # an overlap of 13 tokens with two substitutions has four equal ones in a row
    runs = lambda t: set(zip(*[tokens(t)[k:] for k in range(4)], strict=False))
    own = [(x, runs(x)) for x in items]
    texts = {i: t for i, t in texts.items() if not any(runs(t) & r and overlaps(t, x) for x, r in own)}
    assert set(found) == set(texts)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in texts.items():
        clean = pii.masked(text, [(*s, True, 1.0) for s in pii.fixed(text)])
        ids = library.encode(clean, add_special_tokens=False).ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert found[i]["ids"] == ids and hashlib.sha256(found[i]["decoded"].encode()).hexdigest() == digest


def test_edges(spark, root):
    found = staged(spark, edges(spark), SF, f"{root}/edges").collect()
    assert sorted(r["doc_id"] or 0 for r in found) == [0, 4, 5, 6, 8, 9]
    assert staged(spark, edges(spark).limit(0), SF, f"{root}/empty").count() == 0


def test_clean_documents_stay(spark, root):
    rows = [(i, f"text number {i} about river{i} and stone{i} with house{i} near water{i} and light{i} by tree{i}") for i in range(50)]
    assert staged(spark, edges(spark, rows), SF, f"{root}/clean").count() == 50
