"""Every stage of the pipeline against plain Python, and the registered queries over the smallest tables."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardrisk.llm import packing, quality_model, quality_rules, queries
from wardrisk.llm.shared import piece_ids, stored, vocabulary_file

import corpus_pipeline

from .test_encoding_and_packing import library
from .test_near_copies import groups
from .test_shingle_copies import plain_links, plain_shingles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def plain_scores(rows, net):
    scores = {}
    for r in rows:
        logits = quality_model.chunk_logits(quality_model.chunks_of((r["text"] or "").encode()), net)
        scores[r["doc_id"]] = quality_model.sigmoid(logits.mean())
    return scores


def plain_without_repeats(rows):
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        data = (r["text"] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if data[at:at + 100] in seen:
                gone[at:at + 100] = b"\1" * 100
            seen.add(data[at:at + 100])
        out[r["doc_id"]] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("c0", F.lit(1)).withColumn("kept", F.lit("x"))
    docs = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None)))
    docs = stored(docs, "test")
    net = quality_model.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    memo = piece_ids(vocabulary_file(quality_rules.TOKENS))
    known = quality_rules.pieces_of(vocabulary_file(quality_rules.PIECES))
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = docs.collect()
        if number:
            assert all(r["doc_id"] is not None for r in rows)
        out = stage(spark, docs, SF_DIR)
        if number < 4:
            assert out.dtypes == docs.dtypes
            out = stored(out, "test")
        got = out.collect()
        if number == 0:
            scores = plain_scores([r for r in rows if r["doc_id"] is not None], net)
            want = {i for i, s in scores.items() if s >= 0.7}
            assert {r["doc_id"] for r in got} - {None} == want
            docs = out.where("doc_id IS NOT NULL")
            continue
        if number == 1:
            want = {r["doc_id"] for r in rows if quality_rules.judge(r["text"] or "", memo, known, quality_rules.BANDS)[6]}
            assert {r["doc_id"] for r in got} == want and want
        if number == 2:
            sets = {r["doc_id"]: plain_shingles(r["text"]) for r in rows}
            kept, groups_kept = {r["doc_id"] for r in got}, groups(sorted(sets), plain_links(sets))
            assert kept == set(groups_kept.values())
        if number == 3:
            assert {r["doc_id"]: r["text"] for r in got} == plain_without_repeats(rows)
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        if number == 4:
            tokenizer, want = library(packing.VOCABULARY), {}
            for r in rows:
                ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
                for piece, start in enumerate(range(0, len(ids), 2048)):
                    own = np.array(ids[start:start + 2048], "<u4")
                    want[r["doc_id"], piece] = (start, len(own), zlib.crc32(own.tobytes()))
            assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
        docs = out


def test_near_copies_stage_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the same words in the same order once more"
    rows = [(5, text, "en", "a", 1), (2, text, "en", "b", 1), (2, text, "en", "b", 1), (None, text, "en", "c", 1),
            (None, "quite another text that nobody copies", None, None, None), (8, None, None, None, None)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, schema), SF_DIR).collect()
    assert sorted((r["doc_id"] or -1, r["source"] or "") for r in out) == [(-1, ""), (2, "b"), (8, "")]


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, SF_DIR).collect() == []


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_covers_its_table(spark, name):
    out = queries.QUERIES[name](spark, SF_DIR)
    n_docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if "doc_id" in out.columns:
        assert out.select("doc_id").distinct().count() == n_docs
    else:
        assert out.count() > 0


def test_query_with_sql(spark):
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(corpus_pipeline.__file__), "tools"))
    import check_oracle

    con = check_oracle.connect(SF_DIR)
    for name, sql in queries.ORACLES.items():
        problem, n = check_oracle.compare(spark, con, name, queries.QUERIES[name], sql, SF_DIR)
        assert not problem and n
