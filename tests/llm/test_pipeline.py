"""Each pipeline stage on its own input, and the run as a whole."""

import brute_jaccard
import odd
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
import public_tokenizers

SF = "/root/testdata/sf0.01"


def test_run_against_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in corpus_pipeline.good_documents(spark, docs, SF).collect()}
    classes = brute_jaccard.components({i: texts[i] for i in good}, 5, 80)
    distinct = {i for i, (_, c) in classes.items() if i == c}
    bench = " ".join(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    assert len(bench) > 0
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    assert len(rows) == len(ids) and ids <= distinct and len(distinct) * 0.9 < len(ids)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows[:200]:
        plain = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] <= len(plain) + 5  # masking takes tokens away, but for short spans


@pytest.mark.parametrize("k", range(5))
def test_odd_documents(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = odd.documents(spark, odd.ROWS)
    out = stage(spark, docs, SF)
    assert k == 4 or out.columns == docs.columns
    out.collect()
    none = stage(spark, odd.empty(spark), SF)
    assert none.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5
