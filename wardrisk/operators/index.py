"""Joins on the district key, rates, normalisation and the two risk indices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import per_capita, weighted
from ..functions.fixed import CRIME_LABEL, HEALTH_LABEL

KEY = "kecamatan"


def count_per_key(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def sum_per_key(df: DataFrame, key: str, column: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(column).alias(out))


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The frame, combined by its key; a key with several rows raises an error when it is read.

    The check is the aggregate that the join after it needs the rows spread by anyway.
    """
    others = [c for c in df.columns if c != key]
    repeated = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    row = F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*others))).otherwise(repeated).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[F.col("_row").getField(c).alias(c) for c in others])


def left_fill(base: DataFrame, others, key: str, fills: dict) -> DataFrame:
    """Left join each frame (one row per key) to the base (one row per key), then fill missing numbers.

    Keys that are not unique are refused, as they would multiply rows.  No broadcast is forced: the
    optimizer and AQE pick the strategy from the sizes.
    """
    frames = [one_row_per_key(df, key) for df in (base, *others)]
    return reduce(lambda left, right: left.join(right, key, "left"), frames).fillna(fills)


def rate(df: DataFrame, num: str, den: str, per: float, out: str) -> DataFrame:
    return df.withColumn(out, per_capita(num, den, per))


def minmax(df: DataFrame, columns: dict[str, str], lo: float = 0.0, hi: float = 100.0,
           by: str | None = None) -> DataFrame:
    """Scale columns (``{column: output}``) to ``lo``..``hi``; an empty range gives ``lo``.

    Globally the bounds are one scalar subquery for all columns.  With ``by`` they are
    aggregated per group and joined back, so no window gathers a group in one task.
    """
    bounds = [f(c).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in (("min", F.min), ("max", F.max))]
    if by is None:
        # One column for the bounds: the subquery is in the plan once, however often it is used.
        out = df.withColumn("_bounds", df.agg(F.struct(*bounds).alias("_bounds")).scalar())
        bound = F.col("_bounds").getField
    else:
        # Prefixed copy of the key: null-safe, and no ambiguity with the left side.
        groups = df.groupBy(F.col(by).alias("_by")).agg(*bounds)
        out = df.join(groups, F.col(by).eqNullSafe(F.col("_by")), "left")
        bound = F.col
    scaled = {}
    for i, (c, name) in enumerate(columns.items()):
        low, span = bound(f"_min{i}"), bound(f"_max{i}") - bound(f"_min{i}")
        divisor = F.when(span > 0, span).otherwise(F.lit(1.0))
        scaled[name] = (F.col(c) - low) / divisor * F.lit(hi - lo) + F.lit(lo)
    out = out.withColumns(scaled)
    return out.drop("_bounds", "_by", *[f"_{n}{i}" for i in range(len(columns)) for n in ("min", "max")])


def _crime_rate(df: DataFrame, per: float) -> DataFrame:
    total = F.col("kasus_kriminal_baseline") + F.col("total_kasus_berita_kriminal")
    return rate(df.withColumn("total_kasus_kriminal", total), "total_kasus_kriminal", "jumlah_penduduk", per, "crime_rate")


def _health_rates(df: DataFrame, case_per: float, facility_per: float) -> DataFrame:
    total = F.col("kasus_wabah_baseline") + F.col("total_kasus_berita_wabah")
    df = rate(df.withColumn("total_kasus_wabah", total), "total_kasus_wabah", "jumlah_penduduk", case_per, "incidence_rate")
    return rate(df, "total_faskes", "jumlah_penduduk", facility_per, "hfr")


def _composite(df: DataFrame, weights) -> DataFrame:
    return df.withColumn("indeks_kesehatan", weighted([("norm_ir", weights[0], False), ("norm_hfr", weights[1], True)]))


def crime_index(base: DataFrame, news_counts: DataFrame, key: str = KEY,
                per: float = 100_000, by: str | None = None) -> DataFrame:
    """Cases plus news per inhabitant, scaled to 0..100.

    ``base``: key, jumlah_kasus, jumlah_penduduk; ``news_counts``: key,
    total_kasus_berita_kriminal.  A district without inhabitants keeps a NULL index.
    """
    extra = [] if by is None else [by]
    left = base.select(key, *extra, F.col("jumlah_kasus").alias("kasus_kriminal_baseline"), "jumlah_penduduk")
    joined = left_fill(left, [news_counts.select(key, "total_kasus_berita_kriminal")], key,
                       {"total_kasus_berita_kriminal": 0, "kasus_kriminal_baseline": 0})
    return minmax(_crime_rate(joined, per), {"crime_rate": "indeks_kriminalitas"}, by=by)


def health_index(base: DataFrame, disease: DataFrame, facilities: DataFrame,
                 news_counts: DataFrame, key: str = KEY, case_per: float = 100_000,
                 facility_per: float = 10_000, weights=(0.7, 0.3), by: str | None = None) -> DataFrame:
    """Weighted incidence and (inverted) facility density, each scaled to 0..100.

    ``disease``: key, kasus_wabah_baseline; ``facilities``: key, total_faskes;
    ``news_counts``: key, total_kasus_berita_wabah; each with one row per key.
    """
    extra = [] if by is None else [by]
    joined = left_fill(
        base.select(key, *extra, "jumlah_penduduk"),
        [disease.select(key, "kasus_wabah_baseline"),
         news_counts.select(key, "total_kasus_berita_wabah"),
         facilities.select(key, "total_faskes")],
        key, {"kasus_wabah_baseline": 0, "total_kasus_berita_wabah": 0, "total_faskes": 0})
    rated = _health_rates(joined, case_per, facility_per)
    return _composite(minmax(rated, {"incidence_rate": "norm_ir", "hfr": "norm_hfr"}, by=by), weights)


def dual_index(base: DataFrame, others=(), key: str = KEY, crime_per: float = 100_000,
               case_per: float = 100_000, facility_per: float = 10_000, weights=(0.7, 0.3),
               by: str | None = None) -> DataFrame:
    """Both indices in one frame: the base is joined once, all bounds come from one aggregate.

    ``base`` holds key, jumlah_kasus and jumlah_penduduk; together with ``others`` (frames
    with one row per key) it has to bring kasus_wabah_baseline, total_faskes and the two
    news counts.
    """
    joined = left_fill(base.withColumnRenamed("jumlah_kasus", "kasus_kriminal_baseline"), others, key, {
        c: 0 for c in ("kasus_kriminal_baseline", "total_kasus_berita_kriminal", "kasus_wabah_baseline",
                       "total_kasus_berita_wabah", "total_faskes")})
    rated = _health_rates(_crime_rate(joined, crime_per), case_per, facility_per)
    scaled = minmax(rated, {"crime_rate": "indeks_kriminalitas", "incidence_rate": "norm_ir", "hfr": "norm_hfr"}, by=by)
    return _composite(scaled, weights)


def risk_table(crime: DataFrame, health: DataFrame, key: str = KEY) -> DataFrame:
    """Both saved index tables side by side, whichever of them has the district."""
    return (crime.select(key, "total_kasus_kriminal", "crime_rate", "indeks_kriminalitas")
            .join(health.select(key, "total_kasus_wabah", "incidence_rate", "hfr", "indeks_kesehatan"), key, "full"))


def disease_per_key(disease: DataFrame, key: str = KEY) -> DataFrame:
    return sum_per_key(disease, key, "jumlah_kasus", "kasus_wabah_baseline")


def facilities_per_key(facilities: DataFrame, key: str = KEY) -> DataFrame:
    return count_per_key(facilities, key, "total_faskes")


def snapshot(df: DataFrame, period: str | None = None, period_col: str = "periode",
             distinct_by=None) -> DataFrame:
    """Registry rows of one period and/or one row per facility.

    The indices count every row of every period by default; this makes the narrower
    counts available.
    """
    out = df if period is None else df.filter(F.col(period_col) == period)
    return out if distinct_by is None else out.dropDuplicates(list(distinct_by))


def news_counts(df: DataFrame, place: str, label: str, key: str = KEY) -> DataFrame:
    """News per district and label in one pass: one row per district, both counts.

    A district without news of one label has 0 there.
    """
    return df.groupBy(F.col(place).alias(key)).agg(
        F.count_if(F.col(label) == CRIME_LABEL).alias("total_kasus_berita_kriminal"),
        F.count_if(F.col(label) == HEALTH_LABEL).alias("total_kasus_berita_wabah"))


def news_multiplier(base: DataFrame, counts: DataFrame, key: str, cases: str, news: str,
                    weight: float, out: str) -> DataFrame:
    """Baseline times ``1 + weight * news / average news`` (optional calibration rule)."""
    joined = left_fill(base, [counts.select(key, news)], key, {news: 0})
    mean = joined.agg(F.avg(news)).scalar()
    factor = 1 + F.lit(weight) * F.coalesce(F.try_divide(F.col(news), mean), F.lit(0.0))
    return joined.withColumn(out, F.col(cases) * factor)
