"""The pipeline against the same decisions taken in one process by plain versions."""

import base64
import hashlib
import os

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_similar import kept
from test_texts import contaminated, plain_spans

import corpus_pipeline
from scriptmill.llm import quality, secrets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(spark, docs, folder):
    """(doc_id, n_tokens, ids, decoded) for rows (doc_id, text), rows of one component and key being equal."""
    trees = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r in rows if trees.scores(np.array([quality.statistics(r[1] or "")]))[0] >= quality.THRESHOLD]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    rows = [rows[i] for i in kept([(i, t) for i, (_, t) in enumerate(rows)])]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [r for r in rows if not contaminated(r[1], items)[-1]]
    net, clean = secrets.trained(), []
    for key, text in rows:
        out, at = "", 0
        for a, k, b in plain_spans(net, text or ""):
            if b > at:
                out, at = out + (text or "")[at:a] + (f"[{secrets.KINDS[k]}]" if a >= at else ""), b
        clean.append((key, out + (text or "")[at:]))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [(i, len(x := e.encode_ordinary(t)), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in clean]


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain(spark, docs, SF)
    same(corpus_pipeline.run(spark, SF).collect(), want)
    assert 0 < len(want) < docs.count()


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, repeated and null ids, an empty and a long text, and columns whose names the stages use."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = [r.asDict() for r in docs.orderBy("doc_id").limit(60).collect()]
    rows = first + first[:5] + [first[7] | {"doc_id": None}, first[9] | {"doc_id": 2}, first[20] | {"doc_id": None, "lang": None}]
    rows += [dict.fromkeys(docs.columns), dict.fromkeys(docs.columns) | {"doc_id": 900, "text": ""}, first[3] | {"doc_id": 901, "text": " ".join(x["text"] for x in first if x["lang"] == "en")}]
    clash = ["score", "spans", "_row", "fp", "root", "node", "item", "_text", "_key", "n_words", "item_id", "quality"]
    df = spark.createDataFrame(rows, docs.schema).selectExpr("*", *(f"{i} AS {c}" for i, c in enumerate(clash)))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = plain(spark, docs, str(tmp_path))
    same(corpus_pipeline.run(spark, str(tmp_path)).collect(), want)
    assert len(want) > 20


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), SF).count() == 0
