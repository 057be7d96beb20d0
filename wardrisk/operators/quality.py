"""Data-quality checks that belong beside the indices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import per_capita


def check_rate(df: DataFrame, num: str, den: str, stated: str, per: float, tolerance: float) -> DataFrame:
    """Rows whose stated rate differs from the recomputed one by more than the tolerance."""
    out = df.withColumn("recomputed", per_capita(num, den, per))
    out = out.withColumn("difference", F.abs(F.col(stated) - F.col("recomputed")))
    return out.filter(F.col("difference") > tolerance)


def check_row_totals(df: DataFrame, parts, total: str) -> DataFrame:
    """Rows whose parts do not add up to the stated total."""
    added = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return df.withColumns({"computed": added, "difference": F.col(total) - added}).filter("difference <> 0")


def check_column_totals(df: DataFrame, columns, is_total) -> DataFrame:
    """Per column: sum of the body rows, stated total and their difference."""
    sums = df.agg(*[F.sum(F.when(~is_total, F.col(c))).alias(f"{c}_body") for c in columns],
                  *[F.max(F.when(is_total, F.col(c))).alias(f"{c}_stated") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_body").alias("computed"),
                              F.col(f"{c}_stated").alias("stated")) for c in columns])
    return sums.select(F.inline(rows)).withColumn("difference", F.col("stated") - F.col("computed"))


def check_totals(parts: DataFrame, totals: DataFrame, key: str, part: str, total: str, tolerance: float) -> DataFrame:
    """Keys whose detail rows do not add up to the stated total of another table."""
    added = parts.groupBy(key).agg(F.sum(part).alias("computed"))
    joined = totals.select(key, F.col(total).alias("stated")).join(added, key, "left").fillna({"computed": 0})
    return joined.withColumn("difference", F.abs(F.col("stated") - F.col("computed"))).filter(F.col("difference") > tolerance)


def unmatched_keys(df: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Keys of a table that the base does not have, with their row counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(base.select(key).distinct(), key, "left_anti")


def repeated_values(df: DataFrame, value: str, key: str, min_keys: int = 2) -> DataFrame:
    """Values shared by several keys, with the key count and the first and last key."""
    out = df.groupBy(value).agg(F.count_distinct(key).alias("keys"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    return out.filter(F.col("keys") >= min_keys)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and would multiply rows in a join."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def variants(df: DataFrame, column: str) -> DataFrame:
    """Values that differ only in case or outer spaces: normal form, spelling, rows of each."""
    spelled = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("spelling"))
               .agg(F.count(F.lit(1)).alias("n"))
               .withColumn("normal", F.lower(F.trim("spelling"))))
    several = spelled.groupBy("normal").agg(F.count(F.lit(1)).alias("spellings")).filter("spellings > 1")
    return spelled.join(several, "normal")


# --- alias proposals --------------------------------------------------------------------

def numbered_grams(text: Column, q: int) -> Column:
    """The q-grams of a text with marked ends; the second one of a kind is told apart from the first, and so on."""
    whole = F.concat(F.lit("\x01" * (q - 1)), text, F.lit("\x02" * (q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + (q - 1)), lambda i: F.substr(whole, i, F.lit(q)))

    def counted(listed: Column) -> Column:
        return F.transform(listed, lambda g, i: F.concat(g, F.size(F.filter(F.slice(listed, F.lit(1), i + 1), lambda h: h == g)).cast("string")))

    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.get(F.transform(F.array(grams), counted), F.lit(0)))


def propose_aliases(spelled: DataFrame, known: DataFrame, key: str, max_distance: int = 2, q: int = 2) -> DataFrame:
    """``(key, proposal, distance)``: for each key that is not known the nearest known one within ``max_distance`` edits.

    Ties go to the first known key.  An edit changes at most q of a text's q-grams, so keys that near share one of their
    ``q * max_distance + 1`` rarest ones: those alone are indexed, which keeps frequent grams out of the join.  Texts
    with no more grams than that need share none; they are few (of at most ``q * (max_distance - 1) + 1`` letters) and
    meet each other by a mark.  Pairs of very different lengths are dropped before the distance is computed.
    """
    prefix = q * max_distance + 1
    accepted = known.select(F.col(key).alias("text")).filter("text IS NOT NULL").distinct()
    asked = spelled.select(F.col(key).alias("text")).filter("text IS NOT NULL").distinct().join(accepted, "text", "left_anti")
    both = accepted.withColumn("known", F.lit(True)).unionByName(asked.withColumn("known", F.lit(False)))
    grams = both.select("text", "known", F.explode(numbered_grams(F.col("text"), q)).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rare = F.row_number().over(Window.partitionBy("known", "text").orderBy("n", "gram"))
    index = grams.join(counts, "gram").withColumn("place", rare).filter(F.col("place") <= prefix).select("text", "known", "gram")
    short = both.filter(F.length("text") + (q - 1) < prefix).select("text", "known", F.lit("").alias("gram"))
    index = index.unionByName(short)
    left = index.filter("NOT known").select("gram", F.col("text").alias(key))
    right = index.filter("known").select("gram", F.col("text").alias("proposal"))
    pairs = (left.join(right, "gram").filter(F.abs(F.length(key) - F.length("proposal")) <= max_distance)
             .select(key, "proposal").distinct())
    near = pairs.withColumn("distance", F.levenshtein(key, "proposal")).filter(F.col("distance") <= max_distance)
    best = near.groupBy(key).agg(F.min(F.struct("distance", "proposal")).alias("best"))
    return best.select(key, "best.proposal", "best.distance")
