import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardrisk.operators import quality, report, reshape


def test_trend_and_unpivot(spark, rows):
    df = spark.createDataFrame([("Surabaya", 3377, 1647, 1648, 8759)], "k string, `2019` int, `2020` int, `2021` int, `2022` int")
    long = reshape.to_long(df, ["k"], ["2019", "2020", "2021", "2022"])
    assert long.count() == 4
    change = reshape.trend_change(long.withColumn("tahun", F.col("tahun").cast("int")), "tahun", "jumlah", ["k"]).first()
    assert (change.first_year, change.last_year, change.change_percent) == (2019, 2022, 159.0)


def test_number(spark):
    df = spark.createDataFrame([("1,787",), (" 12 ",), ("x",), (None,), ("",)], "v string")
    assert [r.n for r in df.select(reshape.number("v").alias("n")).collect()] == [1787.0, 12.0, None, None, None]


def series(spark):
    d = dt.date
    spine = reshape.month_spine(spark.createDataFrame([("a",), ("b",)], "k string"), "2025-01-01", "2025-06-01")
    known = spark.createDataFrame([("a", d(2025, 2, 1), 10.0), ("a", d(2025, 5, 1), 40.0)], "k string, month date, v double")
    return spine, known


def test_fill_and_interpolate(spark):
    spine, known = series(spark)
    filled = [r.f for r in reshape.forward_fill(spine, known, "k", "month", "v", "f").filter("k = 'a'").orderBy("month").collect()]
    assert filled == [None, 10.0, 10.0, 10.0, 40.0, 40.0]
    blended = [r.f for r in reshape.interpolate(spine, known, "k", "month", "v", "f").filter("k = 'a'").orderBy("month").collect()]
    assert blended == [10.0, 10.0, 20.0, 30.0, 40.0, 40.0]
    assert {r.f for r in reshape.interpolate(spine, known, "k", "month", "v", "f").filter("k = 'b'").collect()} == {None}
    assert reshape.since(spine, "month", "2025-03-01").count() == 8


def test_spikes(spark):
    counts = [1, 2, 1, 2, 1, 20]
    data = [("a", dt.datetime(2025, 1, 1 + day, hour)) for day, n in enumerate(counts) for hour in range(n)]
    spikes = reshape.news_spikes(spark.createDataFrame(data, "p string, ts timestamp"), "p", "ts").collect()
    # The second day rises after a flat history of one day.
    assert sorted((r.day, r.n) for r in spikes) == [(dt.date(2025, 1, 2), 2), (dt.date(2025, 1, 6), 20)]


def test_spikes_after_flat_and_empty_days(spark):
    flat = [("flat", dt.datetime(2025, 1, 1 + day)) for day in range(7)] + [("flat", dt.datetime(2025, 1, 8, i // 50, i % 50)) for i in range(100)]
    gaps = [("gaps", dt.datetime(2025, 1, 1)), ("gaps", dt.datetime(2025, 1, 20)), (None, dt.datetime(2025, 1, 3)), ("none", None)]
    spikes = reshape.news_spikes(spark.createDataFrame(flat + gaps, "p string, ts timestamp"), "p", "ts").collect()
    assert sorted((r.p, r.day, r.n, r.z) for r in spikes) == [
        ("flat", dt.date(2025, 1, 8), 100, None), ("gaps", dt.date(2025, 1, 20), 1, None)]


def test_union_with_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert rows(reshape.union_all([a, b])) == [(1, 2), (3, None)]


def test_quality_checks(spark, rows):
    base = spark.createDataFrame([("Karang Pilang", 77, 75503, 102.0), ("Wonocolo", 15, 80034, 90.0), ("X", 1, 0, 5.0)],
                                 "k string, n int, p int, stated double")
    assert [r.k for r in quality.check_rate(base, "n", "p", "stated", 100_000, 0.5).collect()] == ["Wonocolo"]
    ages = spark.createDataFrame([("40-44", 119941, 122883, 242824), ("45-49", 112086, 1161146, 228232), ("Jumlah/Total", 232027, 239029, 471056)],
                                 "age string, male int, female int, both int")
    assert [(r.age, r.difference) for r in quality.check_row_totals(ages, ["male", "female"], "both").collect()] == [("45-49", -1045000)]
    totals = {r["column"]: r.difference for r in quality.check_column_totals(ages, ["male", "female"], F.col("age") == "Jumlah/Total").collect()}
    assert totals == {"male": 0, "female": 239029 - 122883 - 1161146}
    names = spark.createDataFrame([("WONOCOLO",), ("Darmo",), ("Darmo",), ("",)], "k string")
    assert rows(quality.unmatched_keys(names, spark.createDataFrame([("WONOCOLO",)], "k string"), "k")) == [("", 1), ("Darmo", 2)]
    people = spark.createDataFrame([("Genteng", 58216), ("Kenjeran", 58216), ("Pakal", 1)], "k string, p int")
    assert rows(quality.repeated_values(people, "p", "k")) == [(58216, 2, "Genteng", "Kenjeran")]
    owners = spark.createDataFrame([("swasta",), ("Swasta",), ("Swasta ",), ("Dinas",), (None,)], "o string")
    assert sorted(r.spelling for r in quality.variants(owners, "o").collect()) == ["Swasta", "Swasta ", "swasta"]
    assert quality.duplicate_keys(owners, "o").count() == 0
    parts = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    stated = spark.createDataFrame([(1, 11.0), (2, 3.0)], "k int, t double")
    assert [r.k for r in quality.check_totals(parts, stated, "k", "v", "t", 0.1).collect()] == [2]


def test_month_stretches_equal_the_spine(spark, rows):
    """Keys with many, one and no point, points outside of the calendar, and months without a value."""
    draw = random.Random(3)
    points = {(f"k{draw.randrange(8)}", dt.date(2024 + draw.randrange(3), draw.randint(1, 12), 1)): draw.choice([None, 1.5, 2.0, 7.0]) for _ in range(60)}
    known = spark.createDataFrame([(k, m, v) for (k, m), v in points.items()], "k string, month date, v double")
    keys = spark.createDataFrame([(f"k{i}",) for i in range(10)], "k string")
    start, end = dt.date(2024, 3, 10), dt.date(2025, 11, 20)
    spine = reshape.month_spine(keys, start, end)
    assert rows(reshape.fill_months(known, "k", "month", "v", "f", start, end, keys)) == rows(reshape.forward_fill(spine, known, "k", "month", "v", "f"))
    assert rows(reshape.blend_months(known, "k", "month", "v", "f", start, end, keys)) == rows(reshape.interpolate(spine, known, "k", "month", "v", "f"))
    assert reshape.fill_months(known.limit(0), "k", "month", "v", "f", start, end).collect() == []
    plan = reshape.blend_months(known, "k", "month", "v", "f", start, end)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most,q", [(1, 2), (2, 2), (2, 3), (3, 2)])
def test_alias_proposals_equal_brute_force(spark, most, q):
    """Short texts, repeated letters and one frequent ending included."""
    draw = random.Random(most * 10 + q)
    names = {"".join(draw.choice("abcab n") for _ in range(draw.randrange(9))).strip() + draw.choice(["", "", " kulon"]) for _ in range(120)} | {"Tenggilis Mejoyo", "Pabean Cantian", ""}
    known = sorted(names)[::2] + ["Tenggilis Mejoyo"]
    asked = sorted(names)[1::2] + ["Tenggilis Mejojo", "Pabean Cantikan", "Pabean Cantian"]
    want = {}
    for a in set(asked) - set(known):
        near = sorted((distance(a, b), b) for b in set(known) if distance(a, b) <= most)
        if near:
            want[a] = near[0]
    spelled = spark.createDataFrame([(a,) for a in asked + asked[:5] + [None]], "k string")
    out = quality.propose_aliases(spelled, spark.createDataFrame([(b,) for b in known + [None]], "k string"), "k", most, q)
    assert {r.k: (r.distance, r.proposal) for r in out.collect()} == want and want


def test_sketches_of_days(spark):
    """Days united give the sketch of all rows; the estimate stays within its bound; a range without rows has none."""
    rows = spark.range(60_000).select((F.col("id") % 23_000).alias("v"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"))
    days = report.daily_sketches(rows, "v", "day")
    ranges = spark.createDataFrame([(dt.date(2025, 1, 1), dt.date(2025, 2, 28)), (dt.date(2025, 1, 5), dt.date(2025, 1, 11)), (dt.date(2020, 1, 1), dt.date(2020, 2, 1))], "first date, last date")
    got = {r["first"]: r.distinct_values for r in report.distinct_between(days, ranges).collect()}
    whole = rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", 12))).first()[0]
    assert got[dt.date(2025, 1, 1)] == whole and abs(whole - 23_000) <= 23_000 * report.sketch_error()
    exact = rows.filter(F.col("day").between("2025-01-05", "2025-01-11")).select("v").distinct().count()
    assert abs(got[dt.date(2025, 1, 5)] - exact) <= exact * report.sketch_error() and got[dt.date(2020, 1, 1)] == 0
