"""Ranks, top and bottom lists, bands and summaries over index tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import band


def rank_desc(df: DataFrame, column: str, key: str, out: str = "rank", by: str | None = None) -> DataFrame:
    """1-based position by descending value, ties by key, NULL values last; with ``by`` per group.

    Both go through :func:`number_rows`, so a hot value or a hot group is no single task.
    """
    order = [F.col(column).desc_nulls_last(), F.col(key).asc()]
    if by is None:
        return number_rows(df, order, out).withColumn(out, F.col(out) + 1)
    numbered = number_rows(df, [F.col(by).asc_nulls_first(), *order], "_place")
    starts = numbered.groupBy(F.col(by).alias("_by")).agg(F.min("_place").alias("_first"))
    return (numbered.join(starts, F.col(by).eqNullSafe(F.col("_by")))
            .withColumn(out, F.col("_place") - F.col("_first") + 1).drop("_place", "_by", "_first"))


def number_rows(df: DataFrame, order, out: str = "index", partitions: int | None = None) -> DataFrame:
    """0-based position of each row of a table of any size in a total order.

    The rows are range-partitioned by the whole order, so a value shared by very many rows is split
    by the columns after it; sorted partitions follow one another, and the sizes of those before give
    a partition's first number.  The numbers within the partitions are checkpointed before the sizes
    are added up: a lost executor cannot move a row to another partition afterwards.
    """
    from ..sources.writers import checkpointed

    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = checkpointed(df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                           .withColumn("_n", F.monotonically_increasing_id()))
    # The id holds the partition number above bit 33 and the row number below.
    numbers = numbers.withColumns({"_part": F.shiftright("_n", 33), "_row": F.col("_n").bitwiseAND(F.lit(2**33 - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (numbers.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
              .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")))
    # One row per partition.
    joined = numbers.join(F.broadcast(starts), "_part")
    return joined.withColumn(out, F.col("_start") + F.col("_row")).drop("_part", "_row", "_n", "_start")


def rank_indices(df: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """Rank by several columns (``{column: output}``), each descending with ties by key."""
    for column, out in columns.items():
        df = rank_desc(df, column, key, out)
    return df


def top_n(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), key).limit(n)


def bottom_n(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    """Lowest values, ascending; among ties the one listed last comes first."""
    return df.orderBy(F.col(column).asc_nulls_first(), F.col(key).desc()).limit(n)


def latest(df: DataFrame, ts: str, n: int, key: str) -> DataFrame:
    """Most recent rows; rows without a date come last."""
    return df.orderBy(F.col(ts).desc_nulls_last(), key).limit(n)


def latest_per_key(df: DataFrame, key: str, ts: str, n: int, tie: str, out: str = "position") -> DataFrame:
    """Latest ``n`` rows per key; the limit also applies before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc_nulls_last(), F.col(tie))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).withColumn(out, F.col("_rn").cast("long")).drop("_rn")


def worst_best(df: DataFrame, column: str, key: str) -> DataFrame:
    """Key and value of the highest and of the lowest row."""
    return df.filter(F.col(column).isNotNull()).agg(
        F.min_by(F.struct(F.col(key).alias("k"), F.col(column).alias("v")),
                 F.struct(-F.col(column), F.col(key))).alias("w"),
        F.max_by(F.struct(F.col(key).alias("k"), F.col(column).alias("v")),
                 F.struct(-F.col(column), F.col(key))).alias("b"),
    ).select(F.col("w.k").alias("worst"), F.col("w.v").alias("worst_value"),
             F.col("b.k").alias("best"), F.col("b.v").alias("best_value"))


def band_histogram(df: DataFrame, column: str, bands, out: str = "band") -> DataFrame:
    """Rows per band; bands without rows appear with 0."""
    labels = [label for label, _, _ in bands]
    counts = df.select(band(column, bands).alias(out)).agg(
        *[F.count_if(F.col(out) == label).alias(f"_{i}") for i, label in enumerate(labels)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(label).alias(out), F.col(f"_{i}").alias("n"))
                     for i, label in enumerate(labels)])
    return counts.select(F.inline(rows))


def above(df: DataFrame, column: str, thresholds) -> DataFrame:
    """Rows above each threshold, one column per threshold."""
    return df.agg(*[F.count_if(F.col(column) > t).alias(f"above_{t:g}") for t in thresholds])
