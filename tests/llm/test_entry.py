"""The registered queries of the subpackage, and the pipeline."""

import hashlib
from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from pointflow.llm import sainte_lague
from pointflow.llm.queries import QUERIES, word_bpe_file

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(names)


# the audit returns rows of groups
@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("op13_")])
def test_query_returns_one_row_per_row(spark, name):
    tables = {"op4": ("pages", "page_id"), "op6": ("pages", "page_id"), "op5": ("embeddings", "vec_id"), "op11": ("embeddings", "vec_id")}
    table, key = tables.get(name.split("_")[0], ("documents", "doc_id"))
    ids = sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in QUERIES[name](spark, FOLDER).select(key).collect()) == ids


def test_pipeline_stages(spark):
    from tokenizers import Tokenizer

    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames = {"documents": source}
    docs = source
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(out.collect(), out.schema)
        frames[name] = docs
        if name != "bpe_tokens":
            assert docs.columns == source.columns
    ids = {name: [r["doc_id"] for r in f.select("doc_id").collect()] for name, f in frames.items()}
    assert set(ids["quality_classifier"]) < set(ids["documents"])

    best = {}
    for r in frames["quality_classifier"].collect():
        best[r["text"].lower() if r["text"].isascii() else r["text"]] = r["doc_id"]
    assert len(ids["exact_dedup"]) == len(set(ids["exact_dedup"])) <= len(best)

    texts = {r["doc_id"]: set(shingles(r["text"])) for r in frames["exact_dedup"].collect()}
    kept = set(ids["minhash_near_dedup"])
    for a in kept:
        for b in kept:
            common = len(texts[a] & texts[b])
            assert a == b or not common or 100 * common < 80 * len(texts[a] | texts[b])
    for a in set(texts) - kept:
        assert any(100 * len(texts[a] & s) >= 80 * len(texts[a] | s) for b, s in texts.items() if b != a)

    words = lambda f: sum(len(r["text"].split()) for r in f.collect())
    assert words(frames["mix_sources"]) == pytest.approx(1.5 * words(frames["minhash_near_dedup"]), rel=0.01)
    assert max(Counter(ids["mix_sources"]).values()) <= 2 * 2

    library = Tokenizer.from_file(word_bpe_file())
    want = Counter()
    for r in frames["mix_sources"].collect():
        got = library.encode(r["text"], add_special_tokens=False).ids
        text = library.decode(got, skip_special_tokens=False)
        want[r["doc_id"], tuple(got), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert want == Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in docs.collect())


def shingles(text):
    words = text.lower().split()
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def test_mixture_query_meets_targets(spark):
    rows = QUERIES["op9_mixture"](spark, FOLDER).collect()
    taken = sum(r["taken"] for r in rows)
    assert taken == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=20 * sainte_lague.BLOCK_WORDS)
