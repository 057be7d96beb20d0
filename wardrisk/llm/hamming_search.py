"""Exact top-k search over 64-bit codes by incremental multi-index hashing.

Codes are cut into four segments of 16 bits and indexed by each.  A code at distance d from a query
is within d // 4 of it in some segment, so probing all values within radius r of every segment finds
every code up to distance 4 * r + 3; with radius r in only j of the segments and r - 1 in the others,
up to 4 * r + j - 1.  Radii grow by one; a query is done when its k-th verified distance is within
that bound, and the others go on.  A query that has k hits probes only as many segments as cover its
k-th distance, and takes no hit beyond it.  At the full radius everything is covered.

Equal codes are one entry with their k least ids: no others can be among the k nearest, as ties are
broken by id.  Equal queries are searched once.

Defined results: rows whose vector is null, has not 64 numbers, or has a null or NaN among them have
no code and are neither found nor searched; null ids are not found; a repeated id is found once per
distinct code; with fewer than k entries all are returned; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS


def sign_code(vector: Column) -> Column:
    """Bit i is set if number i is above zero; null if the vector has not 64 plain numbers."""
    whole = (F.size(vector) == BITS) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    bit = [F.when(F.get(vector, F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
           for i in range(BITS)]
    return F.when(whole, reduce(lambda a, b: a.bitwiseOR(b), bit))


def segments(code: Column) -> Column:
    """(segment number, its value) of a code."""
    return F.array(*[F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned(code, i * WIDTH)
                              .bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int").alias("value")) for i in range(SEGMENTS)])


def nearest(rows: DataFrame, k: int, query: str, *order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(query).orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``codes`` (id, code) and ``queries`` (query_id, code) to rows (query_id, rank, id, distance).

    Ranks go by distance, then by id.
    """
    entries = cut(nearest(codes.where("code IS NOT NULL AND id IS NOT NULL").distinct(), k, "code", "id")
                  .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    index = cut(entries.select("code", "ids", F.inline(segments(F.col("code")))))
    asked = cut(queries.where("code IS NOT NULL").distinct())
    # The bound of a query is its k-th distance so far: no code farther than that can be among its k nearest.
    active = asked.select(F.col("code").alias("query")).distinct().withColumn("bound", F.lit(BITS))
    found, finished = None, []
    for radius in range(WIDTH + 1):
        covered = SEGMENTS * radius - 1
        needed = F.least(F.lit(SEGMENTS), F.col("bound") - covered)
        flips = F.filter(F.sequence(F.lit(0), F.lit((1 << WIDTH) - 1)), lambda x: F.bit_count(x) == radius)
        probes = (active.select("query", "bound", needed.alias("needed"), F.inline(segments(F.col("query"))))
                  .where("segment < needed")
                  .select("query", "bound", "segment", F.col("value").alias("own"), F.explode(flips).alias("flip"))
                  .select("query", "bound", "segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value")))
        distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code")))
        met = (probes["segment"] == index["segment"]) & (probes["value"] == index["value"]) & (distance <= F.col("bound"))
        hits = (probes.join(index, met).select("query", "code", "ids", distance.alias("distance"))
                .dropDuplicates(["query", "code"]).select("query", "distance", F.explode("ids").alias("id")))
        if found is not None:
            hits = hits.unionByName(found.select("query", "distance", "id")).distinct()
        found = cut(nearest(hits, k, "query", "distance", "id"))
        last = found.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("last"))
        reached = F.lit(covered) + needed
        open_ = cut(active.join(last, "query", "left").where(~F.coalesce(F.col("last") <= reached, F.lit(False)))
                    .select("query", F.coalesce("last", F.lit(BITS)).alias("bound")))
        finished.append(found.join(open_, "query", "left_anti") if radius < WIDTH else found)
        if radius == WIDTH or open_.isEmpty():
            break
        found, active = cut(found.join(open_, "query", "left_semi")), open_
    results = reduce(DataFrame.unionByName, finished)
    return asked.join(results, asked["code"] == results["query"]).select("query_id", "rank", "id", "distance")
