"""The quality network, Hamming search, the queries and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardrisk.llm import hamming_search, quality_model

from .conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        text = prose(rng, rng.randint(30, 120))
        good = i % 3 != 0
        rows.append((i, text if good else " ".join(w.upper() + "$$$" for w in text.split()), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_network_on_held_out_rows(labelled):
    net = quality_model.fit(labelled.select("doc_id", "text"), labelled.select("doc_id", "quality"), steps=120)
    rows = (quality_model.score(labelled.select("doc_id", "text", "quality", F.lit("x").alias("score")), net)
            .withColumn("held_out", quality_model.held_out(F.col("doc_id"))).collect())
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    tested = [r for r in rows if r["held_out"]]
    assert sum((r["score"] >= 0.7) == r["quality"] for r in tested) / len(tested) > 0.95


def test_held_out_labels_are_not_used(labelled):
    docs, labels = labelled.select("doc_id", "text"), labelled.select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    assert sorted(map(tuple, quality_model.training_rows(docs, labels).collect())) == sorted(
        map(tuple, quality_model.training_rows(docs, turned).collect()))
    assert quality_model.training_rows(docs, labels, max_rows=20).count() == 20


def test_network_covers_the_whole_text():
    data = bytes(random.Random(1).randbytes(3000))
    chunks = quality_model.chunks_of(data)
    assert all(bytes(c[c < 256].astype(np.uint8)) == data[i * 224:i * 224 + 256] for i, c in enumerate(chunks))
    assert (len(chunks) - 1) * 224 + 256 >= 3000
    assert quality_model.chunks_of(b"").shape == (1, 256)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = quality_model.train([b"abc " * 90, b"$$$ " * 80], np.array([1, 0]), steps=1)
    net = quality_model.Network(*[p.astype(np.float64) for p in net])
    chunks = np.concatenate([quality_model.chunks_of(t) for t in (b"some text " * 60, b"## other " * 20)])
    doc, labels = np.array([0] * (len(chunks) - 1) + [1]), np.array([1, 0])

    def loss(n):
        logits = quality_model.chunk_logits(chunks, n)
        p = quality_model.sigmoid(np.bincount(doc, logits) / np.bincount(doc))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = quality_model.gradients(chunks, doc, labels, net)
    for place in range(len(net)):
        flat = int(rng.choice(np.flatnonzero(slopes[place].ravel()))) if slopes[place].any() else 0
        moved = [p.copy() for p in net]
        moved[place].ravel()[flat] += 1e-5
        change = (loss(quality_model.Network(*moved)) - loss(net)) / 1e-5
        assert abs(change - slopes[place].ravel()[flat]) < 1e-3


def test_network_without_usable_labels(spark, labelled, docs, empty):
    none = labelled.where("false")
    net = quality_model.fit(docs.select("doc_id", "text"), none)
    assert {round(r["score"], 6) for r in quality_model.score(docs, net).collect()} == {0.5}
    ones = labelled.select("doc_id", F.lit(1).alias("quality"))
    net = quality_model.fit(labelled.select("doc_id", "text"), ones)
    assert all(r["score"] > 0.9 for r in quality_model.score(docs, net).collect())
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    assert {tuple(r)[0::2] for r in quality_model.training_rows(labelled.select("doc_id", "text"), odd).collect()} <= {(2, 0)}
    assert quality_model.score(empty, net).collect() == []


def plain_top_k(codes, queries, k):
    return {(q, rank + 1, i, d) for q, c in queries
            for rank, (d, i) in enumerate(sorted({((c ^ x) .bit_count(), i) for i, x in codes})[:k])}


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


@pytest.mark.parametrize("seed", range(2))
def test_hamming_search(spark, seed):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(4)]
    codes = []
    for i in range(300):
        code = rng.choice(centers) if seed else rng.getrandbits(64)
        for _ in range(rng.randint(0, 6)):
            code ^= 1 << rng.randint(0, 63)
        codes.append((i, code))
    codes += [(1000 + i, centers[0]) for i in range(60)]  # more equal codes than k
    queries = [(i, c) for i, c in codes if i % 50 == 0]
    frames = [spark.createDataFrame([(i, signed(c)) for i, c in rows], f"{name} long, code long")
              for rows, name in ((codes + codes[:5], "id"), (queries, "query_id"))]
    got = {tuple(r) for r in hamming_search.top_k(*frames, k=7).collect()}
    assert got == plain_top_k(codes, queries, 7)


def test_hamming_search_odd_rows(spark):
    vectors = [(1, [0.5] * 64), (2, [-0.5] * 64), (3, None), (4, [1.0]), (5, [float("nan")] * 64), (6, [None] * 64),
               (None, [0.5] * 64)]
    coded = spark.createDataFrame(vectors, "id long, v array<float>").select(
        "id", hamming_search.sign_code(F.col("v")).alias("code"))
    assert [r["code"] for r in coded.collect()] == [-1, 0, None, None, None, None, -1]
    queries = coded.where("id IS NOT NULL").withColumnRenamed("id", "query_id")
    got = {tuple(r) for r in hamming_search.top_k(coded, queries, k=5).collect()}
    assert got == {(1, 1, 1, 0), (1, 2, 2, 64), (2, 1, 2, 0), (2, 2, 1, 64)}
    assert hamming_search.top_k(coded.where("false"), queries.where("false")).collect() == []
