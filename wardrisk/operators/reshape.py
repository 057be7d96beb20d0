"""Unpivoting, report tables, unions, and monthly series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent_change
from .index import minmax


def to_long(df: DataFrame, ids, columns, name: str = "tahun", value: str = "jumlah") -> DataFrame:
    """Year (or disease) columns to rows."""
    return df.unpivot(list(ids), list(columns), name, value)


def number(c) -> Column:
    """Report number with thousands commas to double; anything else is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, ",", "")).try_cast("double")


def report_rows(lines: DataFrame, report: str, line: str, name: str, years: dict[str, str],
                sections: dict[str, str], drop_names=()) -> DataFrame:
    """Body rows of report sheets in long form, each with the section it stands in.

    ``lines`` holds the raw cells with the report they come from and a line number.
    ``years`` maps cell columns to years, ``sections`` the text of a section line to its
    label.  Title, header and note lines have no number in the year columns or stand before
    the first section; total lines are named in ``drop_names``.

    Only the few section lines are gathered per report; every other line looks its section
    up there, so a long report is not read by one task.  An empty cell leaves out its own year only.
    """
    label = F.create_map(*[F.lit(x) for pair in sections.items() for x in pair])
    text = F.trim(F.col(name))
    starts = (lines.withColumn("_label", F.try_element_at(label, text)).filter("_label IS NOT NULL")
              .groupBy(report).agg(F.array_sort(F.collect_list(F.struct(F.col(line).alias("at"), "_label"))).alias("_starts")))
    body = lines.filter(F.try_element_at(label, text).isNull() & ~text.isin(*drop_names) if drop_names
                        else F.try_element_at(label, text).isNull())
    body = body.withColumns({c: number(c) for c in years}).dropna(subset=list(years), how="all")
    before = F.filter("_starts", lambda s: s.at < F.col(line))
    placed = body.join(starts, report).withColumn("section", F.try_element_at(before, F.lit(-1)).getField("_label"))
    wide = placed.filter("section IS NOT NULL").select(
        report, "section", text.alias(name), *[F.col(c).alias(y) for c, y in years.items()])
    return to_long(wide, [report, "section", name], list(years.values())).filter("jumlah IS NOT NULL")


def union_all(frames) -> DataFrame:
    """Union by column name; columns missing in a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_sections(df: DataFrame, section: str, labels) -> dict[str, DataFrame]:
    return {label: df.filter(F.col(section) == label) for label in labels}


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def trend_change(df: DataFrame, year: str, value: str, by=(), digits: int = 0) -> DataFrame:
    """First and last value in time per key and the change in percent."""
    ends = df.groupBy(*by).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.min_by(value, year).alias("first_value"), F.max_by(value, year).alias("last_value"))
    return ends.withColumn("change_percent", percent_change("first_value", "last_value", digits))


# --- monthly series -------------------------------------------------------------------

def month_spine(keys: DataFrame, start, end, out: str = "month") -> DataFrame:
    """Every month from start to end for each key row."""
    months = F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.trunc(F.lit(end).cast("date"), "month"),
                        F.expr("interval 1 month"))
    return keys.distinct().withColumn(out, F.explode(months))


def _per_key(key: str, t: str):
    return Window.partitionBy(key).orderBy(t)


def forward_fill(spine: DataFrame, known: DataFrame, key: str, t: str, value: str, out: str) -> DataFrame:
    """Carry the last known value forward; months before the first value stay NULL.

    ``known`` has at most one row per key and month, so a key never has more rows than months.
    """
    joined = spine.join(known.select(key, t, value), [key, t], "left")
    w = _per_key(key, t).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.last(value, ignorenulls=True).over(w))


def interpolate(spine: DataFrame, known: DataFrame, key: str, t: str, value: str, out: str) -> DataFrame:
    """Linear blend between the known months around each month; the ends stay flat."""
    joined = spine.join(known.select(key, t, value), [key, t], "left")
    before = _per_key(key, t).rowsBetween(Window.unboundedPreceding, 0)
    after = _per_key(key, t).rowsBetween(0, Window.unboundedFollowing)
    known_t = F.when(F.col(value).isNotNull(), F.col(t))
    joined = joined.withColumns({
        "_v0": F.last(value, ignorenulls=True).over(before), "_t0": F.last(known_t, ignorenulls=True).over(before),
        "_v1": F.first(value, ignorenulls=True).over(after), "_t1": F.first(known_t, ignorenulls=True).over(after)})

    def months(a, b):
        return F.round(F.months_between(b, a))

    share = F.try_divide(months("_t0", F.col(t)), months("_t0", F.col("_t1")))
    blend = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.coalesce(share, F.lit(0.0))
    return joined.withColumn(out, F.coalesce(blend, "_v0", "_v1")).drop("_v0", "_v1", "_t0", "_t1")


def known_stretches(known: DataFrame, key: str, t: str, value: str, start, end, keys: DataFrame | None = None) -> DataFrame:
    """The months from start to end of each key, made from its known points alone: ``(key, t, value, _t0, _v0, _t1, _v1)``.

    A point reaches until the next one of its key, and the first one back to the start as well, so one window over the
    points finds the stretches and each is expanded where it is; no calendar is joined.  ``_t0, _v0`` is the point before
    (or at) a month and ``_t1, _v1`` the one after.  ``keys`` adds keys that have no point, all of whose months are unknown.
    """
    first, last = (F.trunc(F.lit(d).cast("date"), "month") for d in (start, end))
    points = known.filter(F.col(value).isNotNull() & F.col(t).between(first, last)).select(key, F.col(t).alias("_t0"), F.col(value).alias("_v0"))
    if keys is not None:
        none = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in ("_t0", "_v0")]
        points = points.unionByName(keys.select(key).distinct().select(key, *none))
    w = Window.partitionBy(key).orderBy(F.col("_t0").asc_nulls_first())
    ahead = points.withColumns({"_t1": F.lead("_t0").over(w), "_v1": F.lead("_v0").over(w), "_first": F.lag(F.lit(1)).over(w).isNull()})
    until = F.coalesce(F.add_months("_t1", -1), last)
    kind = points.schema
    unknown = [F.lit(None).cast(kind["_t0"].dataType).alias("_t0"), F.lit(None).cast(kind["_v0"].dataType).alias("_v0")]

    def stretch(begin, stop, *columns):
        return F.struct(begin.alias("_from"), stop.alias("_to"), *columns)

    own = stretch(F.coalesce("_t0", first), until, F.col("_t0"), F.col("_v0"), F.col("_t1"), F.col("_v1"))
    before = stretch(first, F.add_months("_t0", -1), *unknown, F.col("_t0").alias("_t1"), F.col("_v0").alias("_v1"))
    parts = ahead.select(key, F.inline(F.when(F.col("_first") & F.col("_t0").isNotNull(), F.array(before, own)).otherwise(F.array(own))))
    months = parts.filter("_from <= _to").select(
        key, F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))).alias(t), "_t0", "_v0", "_t1", "_v1")
    return months.withColumn(value, F.when(F.col(t) == F.col("_t0"), F.col("_v0")))


def fill_months(known: DataFrame, key: str, t: str, value: str, out: str, start, end, keys: DataFrame | None = None) -> DataFrame:
    """Every month of each key with the last known value; months before the first value are NULL."""
    return known_stretches(known, key, t, value, start, end, keys).select(key, t, value, F.col("_v0").alias(out))


def blend_months(known: DataFrame, key: str, t: str, value: str, out: str, start, end, keys: DataFrame | None = None) -> DataFrame:
    """Every month of each key, linear between the known values around it; the ends stay flat."""
    def months(a, b):
        return F.round(F.months_between(b, a))

    share = F.try_divide(months("_t0", F.col(t)), months("_t0", F.col("_t1")))
    blend = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.coalesce(share, F.lit(0.0))
    return known_stretches(known, key, t, value, start, end, keys).select(key, t, value, F.coalesce(blend, "_v0", "_v1").alias(out))


def since(df: DataFrame, t: str, epoch: str = "2025-01-01") -> DataFrame:
    """Rows from the first month of the baseline on."""
    return df.filter(F.col(t) >= F.lit(epoch).cast("date"))


def monthly_index(rates: DataFrame, month: str, rate: str, out: str) -> DataFrame:
    """Scale a rate to 0..100 within each month."""
    return minmax(rates, {rate: out}, by=month)


def news_spikes(news: DataFrame, place: str, ts: str, window_days: int = 7, threshold: float = 2.0) -> DataFrame:
    """Days whose news count exceeds the mean of the days before by ``threshold`` deviations.

    News is counted per place and day first; days without news between the first and the last of a
    place count 0.  After a flat history, which has no deviation, any rise is an alert with NULL ``z``.
    """
    counted = (news.groupBy(place, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
               .filter("day IS NOT NULL"))
    spine = (counted.groupBy(F.col(place).alias("_place")).agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
             .select("_place", F.explode(F.sequence("_first", "_last")).alias("_day")))
    same = F.col("_place").eqNullSafe(F.col(place)) & (F.col("_day") == F.col("day"))
    daily = spine.join(counted, same, "left").select(
        F.col("_place").alias(place), F.col("_day").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))
    number_of_day = F.unix_date("day")
    w = Window.partitionBy(place).orderBy(number_of_day).rangeBetween(-window_days, -1)
    scored = daily.withColumns({"mean": F.avg("n").over(w), "deviation": F.stddev_pop("n").over(w),
                                "days_before": F.count("n").over(w)})
    z = F.try_divide(F.col("n") - F.col("mean"), F.nullif(F.col("deviation"), F.lit(0.0)))
    flat = (F.col("deviation") == 0) & (F.col("n") > F.col("mean"))
    return scored.withColumn("z", z).filter((F.col("z") > threshold) | flat)
