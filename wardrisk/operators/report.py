"""Products built from the index tables: recap, profile, report, summaries, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import band, fixed, fixed_text, normalize_key
from .clean import first_per_key
from .index import KEY
from .rank import latest_per_key, rank_indices

CRIME, HEALTH = "indeks_kriminalitas", "indeks_kesehatan"


def dual_recap(risk: DataFrame, key: str = KEY) -> DataFrame:
    """Both indices per district with a crime index; a missing health index counts as 0."""
    return risk.filter(F.col("total_kasus_kriminal").isNotNull()).select(
        key, CRIME, F.coalesce(HEALTH, F.lit(0.0)).alias(HEALTH))


def first_per_name(table: DataFrame, key: str, columns, order=()) -> DataFrame:
    """``_key`` and columns of the first row per normalised name, in the given order, then by the name as it stands.

    Two spellings of a name are one place; a lookup must not repeat what it looks up.
    """
    keyed = table.withColumn("_key", normalize_key(key))
    return first_per_key(keyed, ["_key"], [*order, F.col(key).asc(), *[F.col(c).asc_nulls_last() for c in columns]]).select("_key", *columns)


def lookup_by_name(df: DataFrame, table: DataFrame, name: str, key: str, columns, order=()) -> DataFrame:
    """Left join on the normalised name, one row per row of ``df``; numbers that are missing become 0."""
    side = first_per_name(table, key, list(columns), order)
    joined = df.withColumn("_key", normalize_key(name)).join(side, "_key", "left").drop("_key")
    return joined.fillna(0, list(columns))


def ranked(risk: DataFrame, key: str = KEY) -> DataFrame:
    """Both indices with their ranks; a district without an index has rank 0 there."""
    out = rank_indices(risk, {CRIME: "crime_rank", HEALTH: "health_rank"}, key)
    return out.withColumns({
        "crime_rank": F.when(F.col("total_kasus_kriminal").isNotNull(), F.col("crime_rank")).otherwise(F.lit(0)),
        "health_rank": F.when(F.col("total_kasus_wabah").isNotNull(), F.col("health_rank")).otherwise(F.lit(0))})


def profile(risk: DataFrame, dimension: DataFrame | None = None, headlines: DataFrame | None = None,
            key: str = KEY) -> DataFrame:
    """District profile: indices, ranks, risk level, colour steps, figures, latest headlines.

    ``risk`` is the output of :func:`~wardrisk.operators.index.dual_index` or ``risk_table``,
    ``headlines`` that of :func:`headline_lists`.
    """
    out = ranked(risk, key).withColumn("place_key", normalize_key(key)).select(
        "place_key", key, "total_kasus_kriminal", "crime_rate", CRIME, "crime_rank",
        "total_kasus_wabah", "hfr", HEALTH, "health_rank")
    out = out.fillna(0, ["total_kasus_kriminal", "crime_rate", CRIME, "total_kasus_wabah", "hfr", HEALTH]).withColumns({
        "risk_level": band(CRIME, fixed.RISK_LEVELS),
        "crime_step": band(CRIME, fixed.COLOUR_STEPS),
        "health_step": band(HEALTH, fixed.COLOUR_STEPS),
    })
    if dimension is not None:
        figures = [c for c in dimension.columns if c != "place_key"]
        side = first_per_name(dimension, "place_key", figures).withColumnRenamed("_key", "place_key")
        out = out.join(side, "place_key", "left")
    if headlines is not None:
        out = out.join(headlines, "place_key", "left").fillna({"headlines": ""})
    return out.drop("place_key")


def headline_lists(news: DataFrame, place: str, title: str, ts: str, news_id: str, n: int = 3) -> DataFrame:
    """Latest ``n`` titles per place as one text; at most ``n`` rows per place are gathered."""
    keyed = news.select(normalize_key(place).alias("place_key"), title, ts, news_id)
    latest = latest_per_key(keyed, "place_key", ts, n, news_id)
    listed = F.array_sort(F.collect_list(F.struct("position", F.coalesce(title, F.lit("")).alias("t"))))
    return latest.groupBy("place_key").agg(F.array_join(F.transform(listed, lambda s: s.t), "; ").alias("headlines"))


def risk_report(risk: DataFrame, key: str = KEY) -> DataFrame:
    """Index values as shown (one decimal), ranks, levels and advice per district."""
    shown = {"crime_shown": F.coalesce(F.round(CRIME, 1), F.lit(0.0)),
             "health_shown": F.coalesce(F.round(HEALTH, 1), F.lit(0.0))}
    priority = F.when(F.col("crime_shown") > F.col("health_shown"), fixed.PRIORITY_CRIME).otherwise(fixed.PRIORITY_HEALTH)
    return ranked(risk, key).withColumns(shown).select(
        key, "crime_shown", "health_shown", "crime_rank", "health_rank",
        F.coalesce("total_kasus_kriminal", F.lit(0)).alias("total_kasus_kriminal"),
        F.coalesce("total_kasus_wabah", F.lit(0)).alias("total_kasus_wabah"),
        band("crime_shown", fixed.RISK_LEVELS).alias("risk_level"),
        band("crime_shown", fixed.CRIME_ADVICE).alias("crime_advice"),
        band(F.coalesce(F.col(HEALTH), F.lit(0.0)), fixed.HEALTH_ADVICE).alias("health_advice"),
        fixed_text(F.coalesce(F.col("crime_rate"), F.lit(0.0)), 3).alias("crime_rate_shown"),
        priority.alias("priority"),
        F.concat(fixed_text(F.coalesce(F.col("hfr"), F.lit(0.0)) * 100, 2), F.lit("%")).alias("hfr_shown"))


def _worst(column: str, key: str) -> Column:
    """Key of the highest value, the first key among ties."""
    return F.min_by(key, F.when(F.col(column).isNotNull(), F.struct(-F.col(column), F.col(key))))


def _best(column: str, key: str) -> Column:
    """Key of the lowest value, the last key among ties."""
    return F.max_by(key, F.when(F.col(column).isNotNull(), F.struct(-F.col(column), F.col(key))))


def city_summary(risk: DataFrame, change: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """One row: totals, mean indices, worst and best district, percent change if given."""
    totals = risk.agg(
        F.sum("total_kasus_kriminal").alias("total_crime"), F.avg(CRIME).alias("mean_crime_index"),
        F.count("total_kasus_kriminal").alias("districts"),
        F.sum("total_kasus_wabah").alias("total_health"), F.avg(HEALTH).alias("mean_health_index"),
        _worst(CRIME, key).alias("worst_crime"), _best(CRIME, key).alias("best_crime"),
        _worst(HEALTH, key).alias("worst_health"))
    return totals if change is None else single_row([totals, change])


def kpi_row(risk: DataFrame, news: DataFrame, key: str = KEY) -> DataFrame:
    """District count, highest value and place of both indices, news count."""
    totals = risk.agg(
        F.count("total_kasus_kriminal").alias("districts"),
        _worst(CRIME, key).alias("top_crime"), F.round(F.max(CRIME), 1).alias("top_crime_value"),
        _worst(HEALTH, key).alias("top_health"), F.round(F.max(HEALTH), 1).alias("top_health_value"))
    return single_row([totals, news.agg(F.count(F.lit(1)).alias("news_total"))])


def single_row(frames) -> DataFrame:
    """Put one-row frames side by side, the later ones as scalar subqueries on the first."""
    first, *rest = frames
    out = first
    for frame in rest:
        row = frame.select(F.struct("*").alias("_row")).scalar()
        out = out.withColumn("_row", row)
        out = out.withColumns({c: F.col("_row").getField(c) for c in frame.columns}).drop("_row")
    return out


def news_summary(news: DataFrame, kind: str, place: str, ts: str, crime_label: str) -> DataFrame:
    """News count, crime news, all other news, distinct places, latest date."""
    return news.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(kind) == crime_label).alias("crime_news"),
        F.count_if(F.coalesce(F.col(kind) != crime_label, F.lit(True))).alias("other_news"),
        F.count_distinct(place).alias("places"),
        F.max(ts).alias("latest"))


def compare(risk: DataFrame, a: str, b: str, key: str = KEY) -> DataFrame:
    """Two districts side by side, one row per figure, with a mark for the better index.

    Both rows are picked in one pass.  The lower index is the better one and carries the
    downward mark; figures without a winner have no mark.
    """
    metrics = [CRIME, "total_kasus_kriminal", "crime_rate", HEALTH, "total_kasus_wabah", "hfr"]
    name = normalize_key(key)

    def pick(metric: str, who: str) -> Column:
        value = F.max(F.when(name == normalize_key(F.lit(who)), F.col(metric))).cast("double")
        return F.coalesce(value, F.lit(0.0)) if metric in (CRIME, HEALTH) else value

    picked = risk.filter(name.isin(*[_key_text(x) for x in (a, b)])).agg(
        *[pick(m, who).alias(f"{m}_{side}") for m in metrics for side, who in (("a", a), ("b", b))])
    rows = F.array(*[F.struct(F.lit(m).alias("figure"), F.col(f"{m}_a").alias("value_a"), F.col(f"{m}_b").alias("value_b"),
                              F.lit(m in (CRIME, HEALTH)).alias("marked")) for m in metrics])
    table = picked.select(F.inline(rows))
    better = F.col("value_a") <= F.col("value_b")
    return table.select(
        "figure", "value_a", "value_b",
        F.when(F.col("marked"), F.when(better, "▼").otherwise("▲")).alias("mark_a"),
        F.when(F.col("marked"), F.when(better, "▲").otherwise("▼")).alias("mark_b"))


def _key_text(name: str) -> str:
    """The normalised key of a literal name."""
    key = name.lower()
    for word in ("kecamatan", "kec."):
        key = key.replace(word, "", 1)
    return key.strip(" ")


def district_context(risk: DataFrame, headlines: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """One text per district: crime line, health line and latest headlines, where present."""
    table = risk.withColumn("place_key", normalize_key(key))
    lines = [
        F.when(F.col("total_kasus_kriminal").isNotNull(), F.concat(
            F.lit("Kriminalitas: indeks="), fixed_text(CRIME, 1), F.lit("/100, total_kasus="),
            F.col("total_kasus_kriminal").cast("string"), F.lit(", crime_rate="), fixed_text("crime_rate", 1))),
        F.when(F.col("total_kasus_wabah").isNotNull(), F.concat(
            F.lit("Kesehatan: indeks="), fixed_text(HEALTH, 1), F.lit("/100, total_wabah="),
            F.col("total_kasus_wabah").cast("string"), F.lit(", HFR="), fixed_text("hfr", 2))),
    ]
    if headlines is not None:
        table = table.join(headlines, "place_key", "left")
        lines.append(F.concat(F.lit("Berita terkini: "), F.col("headlines")))
    return table.select(key, F.concat_ws("\n", *lines).alias("context"))


def city_context(risk: DataFrame, key: str = KEY, n: int = 3) -> DataFrame:
    """One row with the top districts of both indices as text and both case totals.

    The lists hold the ``n`` first ranks only, everything comes from one aggregate.
    """
    def tops(column: str, position: str) -> Column:
        label = F.concat(F.col(key), F.lit("("), fixed_text(column, 1), F.lit(")"))
        first = F.collect_list(F.when(F.col(position).between(1, n), F.struct(F.col(position).alias("p"), label.alias("t"))))
        return F.array_join(F.transform(F.array_sort(first), lambda s: s.t), ", ")

    return ranked(risk, key).agg(
        tops(CRIME, "crime_rank").alias("top_crime"), tops(HEALTH, "health_rank").alias("top_health"),
        F.count("total_kasus_kriminal").alias("districts"), F.sum("total_kasus_kriminal").alias("total_crime"),
        F.sum("total_kasus_wabah").alias("total_health"))


def news_detail(news: DataFrame, risk: DataFrame, place: str, key: str = KEY) -> DataFrame:
    """News with the indices and the crime rank of its district (rank 0 if unknown)."""
    side = first_per_name(rank_indices(risk, {CRIME: "crime_rank"}, key), key, [CRIME, HEALTH, "crime_rank"], [F.col("crime_rank").asc()])
    joined = news.withColumn("_key", normalize_key(place)).join(side, "_key", "left").drop("_key")
    return joined.fillna({"crime_rank": 0})


# --- distinct counts from stored sketches -----------------------------------------------

def daily_sketches(df: DataFrame, value: str, ts: str, lg_size: int = 12) -> DataFrame:
    """``(day, sketch)``: a mergeable sketch of the distinct values of each day, to be stored; undated rows are left out."""
    return (df.groupBy(F.to_date(ts).alias("day")).agg(F.hll_sketch_agg(value, lg_size).alias("sketch")).filter("day IS NOT NULL"))


def distinct_between(sketches: DataFrame, ranges: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """The ranges with the estimated ``distinct_values`` of their days, by the union of the days' sketches."""
    met = ranges.join(sketches, F.col("day").between(F.col(first), F.col(last)), "left")
    return met.groupBy(*ranges.columns).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_values"))


def sketch_error(lg_size: int = 12, deviations: float = 3.0) -> float:
    """Relative error that an estimate stays within, at so many deviations."""
    return deviations * 1.04 / (1 << lg_size) ** 0.5
