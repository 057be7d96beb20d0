"""Hard negatives by a vertical scan of vectors (BOND).

All rows are dealt out in strips and the anchors in blocks, by hash; a strip meets a block in one group, which holds both
and nothing else.  There the strip lies column by column.  For each anchor the columns are read in the order of the
anchor's descending magnitude.  After some of them a row's score is known up to what the other columns can add, which
their least and largest values in the strip bound from below and above.  A bitmap holds the rows that may still matter:

* positives: those that can reach the k-th best row of the anchor's label;
* negatives: those whose bounds meet the window of a positive's score, and that can reach the k-th best of the rows
  certainly in it.

What is left after the last column has its exact score.  The best of all strips are merged in windows of Spark; the
negatives' scan starts when every anchor's positives are known.

Defined results: rows with a null id, label or vector, or with a component that is null, not finite or too large for
exact 64-bit sums take no part; a shorter vector ends in zeros; of rows with one id the one with the least label, then
the least vector, counts; an anchor without another row of its label gives no rows; a positive whose window is empty
gives none; an empty table gives no rows; columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

POSITIVES, NEGATIVES, SCALE = 5, 10, 256
#: Shares of the positive's score between which negatives lie, in hundredths.
LEAST, MOST = 30, 90
#: Rows of a strip and anchors of a block, about.
STRIP, BLOCK = 65536, 4096
#: The bitmap is looked at again after so many columns.
STEP = 8


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """Valid rows ``(id, label, v)`` with components as whole numbers, one per id, all of one length."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), label.alias("label"), F.col(f"`{vector}`").alias("x"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    most = float(int((2 ** 62 / max(dims, 1)) ** 0.5))
    scaled = rows.select("id", "label", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("x"))
    scaled = scaled.where(F.forall("x", lambda c: F.abs(c) <= most)).select(
        "id", "label", F.transform("x", lambda c: c.cast("long")).alias("x"))
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    one = scaled.groupBy("id").agg(F.min(F.struct("label", padded.alias("v"))).alias("row"))
    return one.select("id", F.col("row.label").alias("label"), F.col("row.v").alias("v"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


class Strip:
    """Rows column by column, with the least and the largest value of each column."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.columns = np.ascontiguousarray(matrix(table.column("v")).T)
        self.least, self.largest = self.columns.min(1, initial=0), self.columns.max(1, initial=0)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Of the candidates ``rows`` those that ``keep(scores, lowest, highest)`` leaves, with their scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        low = np.minimum(anchor * self.least, anchor * self.largest)[order]
        high = np.maximum(anchor * self.least, anchor * self.largest)[order]
        rest_low, rest_high = low[::-1].cumsum()[::-1], high[::-1].cumsum()[::-1]
        scores = np.zeros(len(rows), np.int64)
        for start in range(0, len(order), STEP):
            if not len(rows):
                break
            for d in order[start:start + STEP]:
                if anchor[d]:
                    scores += anchor[d] * self.columns[d][rows]
            after = start + STEP
            lowest, highest = (scores + rest_low[after], scores + rest_high[after]) if after < len(order) else (scores, scores)
            alive = keep(lowest, highest)
            if not alive.all():
                rows, scores = rows[alive], scores[alive]
        return rows, scores


def kth(values: np.ndarray, k: int) -> int | None:
    """The k-th largest value, if there are so many."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the first ``k`` by descending score, then by id."""
    return np.lexsort((ids, -scores))[:k]


def near_positives(strip: Strip, anchor: np.ndarray, anchor_id: int, label, k: int):
    def keep(lowest, highest):
        bar = kth(lowest, k)
        return np.ones(len(lowest), bool) if bar is None else highest >= bar

    rows, scores = strip.scan(anchor, np.flatnonzero((strip.labels == label) & (strip.ids != anchor_id)), keep)
    first = best(strip.ids[rows], scores, k)
    return strip.ids[rows[first]], scores[first]


def near_negatives(strip: Strip, anchor: np.ndarray, label, scores_of_positives: np.ndarray, k: int, least: int, most: int):
    """For each distinct positive score the ids and scores of the first ``k`` rows of other labels in its window."""
    # least * p <= 100 * score <= most * p, for whole scores; floor division is exact
    windows = {int(p): (-(-least * int(p) // 100), most * int(p) // 100) for p in np.unique(scores_of_positives)}
    windows = {p: w for p, w in windows.items() if w[0] <= w[1]}

    def keep(lowest, highest):
        alive = np.zeros(len(lowest), bool)
        for first, last in windows.values():
            bar = kth(lowest[(lowest >= first) & (highest <= last)], k)
            alive |= (highest >= (first if bar is None else max(first, bar))) & (lowest <= last)
        return alive

    if not windows:
        return
    rows, scores = strip.scan(anchor, np.flatnonzero(strip.labels != label), keep)
    for p, (first, last) in windows.items():
        inside = np.flatnonzero((scores >= first) & (scores <= last))
        ids, own = strip.ids[rows[inside]], scores[inside]
        some = best(ids, own, k)
        yield p, ids[some], own[some]


def dealt(rows: DataFrame, own: str, n: int, other: str, n_other: int) -> DataFrame:
    """Each row in its own share and in a copy for each share of the other side."""
    return rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def ranked(rows: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(other)))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST, strip: int = STRIP, block: int = BLOCK) -> DataFrame:
    """``rows`` and ``anchors`` (some of them), both ``(id, label, v)``, to rows (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)."""
    anchors = anchors.toDF(*anchors.columns)  # columns of its own, as both may come from one table
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_rows, n_anchors = rows.count(), anchors.count()
    n_blocks = max(1, -(-n_anchors // block))
    # At least as many groups as cores, as far as they have rows; the result does not depend on it.
    n_strips = max(1, -(-n_rows // strip), min(-(-cores // n_blocks), n_rows // 1024))
    strips = dealt(rows, "strip", n_strips, "block", n_blocks).groupBy("strip", "block")

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            own = Strip(left)
            for i, label, v in zip(right.column("id").to_pylist(), right.column("label").to_pylist(), matrix(right.column("v"))):
                ids, scores = near_positives(own, v, i, label, positives)
                found += [(i, p, s) for p, s in zip(ids.tolist(), scores.tolist())]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else [()] * 3)], ["anchor_id", "positive_id", "positive_score"])

    schema = "anchor_id long, positive_id long, positive_score long"
    asked = dealt(anchors, "block", n_blocks, "strip", n_strips).groupBy("strip", "block")
    pairs = stored(ranked(strips.cogroup(asked).applyInArrow(find_positives, schema), ["anchor_id"], "positive_score", "positive_id",
                          positives).drop("rank"), "positives")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            own = Strip(left)
            for i, label, v, wanted in zip(right.column("id").to_pylist(), right.column("label").to_pylist(), matrix(right.column("v")),
                                           right.column("wanted").to_pylist()):
                for p, ids, scores in near_negatives(own, v, label, np.array(wanted, np.int64), negatives, least, most):
                    found += [(i, p, n, s) for n, s in zip(ids.tolist(), scores.tolist())]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else [()] * 4)],
                        ["anchor_id", "positive_score", "negative_id", "negative_score"])

    wanted = pairs.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("wanted")).withColumnRenamed("anchor_id", "id")
    asked = dealt(anchors.join(wanted, "id"), "block", n_blocks, "strip", n_strips).groupBy("strip", "block")
    strips = dealt(rows, "strip", n_strips, "block", n_blocks).groupBy("strip", "block")
    hits = strips.cogroup(asked).applyInArrow(find_negatives, "anchor_id long, positive_score long, negative_id long, negative_score long")
    # Positives with one score have one window.
    near = ranked(hits, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    return pairs.join(near, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
                   scale: int = SCALE, **options) -> DataFrame:
    """Mine ``vectors``; ``label`` is each row's label and ``is_anchor`` a condition on the column ``id``."""
    rows = stored(whole_numbers(vectors, vec_id, vector, label, scale), "vectors")
    return mine(rows, rows.where(is_anchor), **options)
