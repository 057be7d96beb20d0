"""Byte-level convolutional network in numpy that scores the quality of whole documents.

A text is read as UTF-8 bytes in overlapping chunks that cover all of it.  Byte embeddings pass
learned filters, each filter is max-pooled over its chunk, a hidden layer gives every chunk a logit,
and the mean logit of the document becomes one probability.  Only the text is an input.

The network is trained on the driver from a bounded sample of labelled rows (``max_rows`` documents,
the lowest by a hash of the id, and ``max_chunks`` chunks of each); scoring reads every byte.

Defined results: a null or empty text is one empty chunk and gets a score like any other; rows with
a null label, or ids without a label, take no part in training; of several labels for an id the
majority counts, a tie as 0; repeated rows are scored each; with no usable label of both kinds every
score is the share of ones (0.5 without labels); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import slices, texts_of

CHUNK, STEP = 256, 224  #: bytes of a chunk, and from one chunk's start to the next one's
STRIDE, KERNEL = 2, 4  #: bytes a filter moves by, and its width in such strides
EMBEDDING, FILTERS, HIDDEN = 6, 32, 16
MAX_ROWS, MAX_CHUNKS, STEPS, THRESHOLD = 4000, 4, 450, 0.7


class Network(NamedTuple):
    embedding: np.ndarray  # (257, EMBEDDING); byte 256 is the padding
    filters: np.ndarray    # (STRIDE * EMBEDDING, KERNEL, FILTERS)
    filter_bias: np.ndarray
    hidden: np.ndarray     # (FILTERS, HIDDEN)
    hidden_bias: np.ndarray
    out: np.ndarray        # (HIDDEN,)
    out_bias: np.ndarray   # (1,)


def held_out(doc_id: Column) -> Column:
    """Ids whose labels are never used: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunks_of(data: bytes) -> np.ndarray:
    """Every byte of the text in overlapping chunks, the last one padded."""
    n = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
    padded = np.full((n - 1) * STEP + CHUNK, 256, dtype=np.int16)
    padded[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def blocks_of(chunks: np.ndarray, net: Network) -> np.ndarray:
    return net.embedding[chunks].reshape(len(chunks) * CHUNK // STRIDE, STRIDE * EMBEDDING)


def convolve(chunks: np.ndarray, net: Network) -> np.ndarray:
    """Filter responses (chunk, place, filter) before pooling."""
    places, last = CHUNK // STRIDE, CHUNK // STRIDE - KERNEL + 1
    parts = (blocks_of(chunks, net) @ net.filters.reshape(STRIDE * EMBEDDING, -1)).reshape(-1, places, KERNEL, FILTERS)
    total = parts[:, :last, 0].copy()
    for k in range(1, KERNEL):
        total += parts[:, k:k + last, k]
    return total


def chunk_logits(chunks: np.ndarray, net: Network) -> np.ndarray:
    logits = np.empty(len(chunks))
    for start in range(0, len(chunks), 256):
        pooled = np.maximum(convolve(chunks[start:start + 256], net).max(axis=1) + net.filter_bias, 0)
        logits[start:start + 256] = np.maximum(pooled @ net.hidden + net.hidden_bias, 0) @ net.out + net.out_bias
    return logits


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gradients(chunks: np.ndarray, doc: np.ndarray, labels: np.ndarray, net: Network) -> Network:
    """Of the mean cross-entropy; ``doc`` has the document of each chunk."""
    n, rows = len(chunks), np.arange(len(chunks))[:, None]
    maps = convolve(chunks, net)
    best = maps.argmax(axis=1)
    pooled = np.take_along_axis(maps, best[:, None, :], axis=1)[:, 0] + net.filter_bias
    active = np.maximum(pooled, 0)
    inner = active @ net.hidden + net.hidden_bias
    fired = np.maximum(inner, 0)
    sizes = np.bincount(doc, minlength=len(labels))
    score = sigmoid(np.bincount(doc, fired @ net.out + net.out_bias, len(labels)) / sizes)
    d_logit = ((score - labels) / sizes)[doc] / len(labels)
    d_inner = np.outer(d_logit, net.out) * (inner > 0)
    d_pooled = (d_inner @ net.hidden.T) * (pooled > 0)
    blocks = blocks_of(chunks, net).reshape(n, CHUNK // STRIDE, STRIDE * EMBEDDING)
    d_filters, d_embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
    for k in range(KERNEL):
        at = blocks[rows, best + k]  # (chunk, filter, input): what each filter saw where it responded most
        d_filters[:, k] = np.einsum("nf,nfi->if", d_pooled, at)
        d_input = (d_pooled[:, :, None] * net.filters[:, k].T[None]).reshape(n, FILTERS, STRIDE, EMBEDDING)
        for s in range(STRIDE):
            seen = chunks[rows, (best + k) * STRIDE + s]
            np.add.at(d_embedding, seen, d_input[:, :, s])
    return Network(d_embedding, d_filters, d_pooled.sum(0), active.T @ d_inner, d_inner.sum(0),
                   fired.T @ d_logit, np.array([d_logit.sum()]))


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, max_chunks: int = MAX_CHUNKS,
          seed: int = 7) -> Network:
    """Adam over small batches; the same rows give the same network."""
    rng = np.random.default_rng(seed)
    shapes = ((257, EMBEDDING, 0.5), (STRIDE * EMBEDDING, KERNEL, FILTERS, 0.3), (FILTERS, 0), (FILTERS, HIDDEN, 0.25),
              (HIDDEN, 0), (HIDDEN, 0.25), (1, 0))
    net = Network(*[(rng.normal(size=shape) * scale).astype(np.float32) for *shape, scale in shapes])
    share = float(np.mean(labels)) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        quiet = [np.zeros_like(p) for p in net]
        quiet[-1] += np.float32(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return Network(*quiet)
    chunks = []
    for text in texts:
        own = chunks_of(text)
        chunks.append(own[np.unique(np.linspace(0, len(own) - 1, min(max_chunks, len(own))).astype(int))])
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first, second = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    for step in range(1, steps + 1):
        rows = rng.choice(len(texts), size=64, p=weights / weights.sum())  # both kinds count alike
        doc = np.repeat(np.arange(len(rows)), [len(chunks[i]) for i in rows])
        slope = gradients(np.concatenate([chunks[i] for i in rows]), doc, labels[rows], net)
        rate = 0.01 * (1 - 0.95 * step / steps)
        new = []
        for i, (p, g) in enumerate(zip(net, slope)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            ahead = first[i] / (1 - 0.9 ** step) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-6)
            new.append((p - rate * ahead).astype(np.float32))
        net = Network(*new)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The bounded sample of labelled documents (text, label), none of them held out."""
    known = (labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
             .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("int").alias("quality")))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    drawn = known.orderBy(*order).limit(max_rows)  # the lowest by hash: a top-k by partition, then of those
    most = (CHUNK + STEP * (MAX_CHUNKS * 8)) // 2
    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "quality")
            .withColumn("text", F.when(F.length("text") <= 2 * most, F.col("text"))
                        .otherwise(F.concat(F.substring("text", 1, most), F.expr(f"right(text, {most})"))))
            .orderBy(*order, "text").limit(2 * max_rows))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, steps: int = STEPS) -> Network:
    rows = training_rows(docs, labels, max_rows).collect()
    return train([r["text"].encode("utf-8", "replace") for r in rows], np.array([r["quality"] for r in rows]), steps)


def score(docs: DataFrame, net: Network, column: str = "score", text: str = "text") -> DataFrame:
    """All columns of the documents and their score, rounded to 9 places; it replaces a column of its name."""
    kept = [c for c in docs.columns if c != column]
    place = kept.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = [chunks_of(x.encode("utf-8", "replace")) for x in texts_of(batch, batch.schema.names[place])]
            sizes = np.array([len(c) for c in chunks])
            logits = chunk_logits(np.concatenate(chunks), net)
            means = np.add.reduceat(logits, np.cumsum(sizes) - sizes) / sizes
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(np.round(sigmoid(means), 9))], batch.schema.names + [column])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"`{column}` double"])
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(scored, schema)
