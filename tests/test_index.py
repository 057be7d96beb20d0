"""Indices against published figures, and ranks, bands and products on edge values."""

import pytest
from pyspark.sql import functions as F

from wardrisk.functions import fixed
from wardrisk.operators import index, rank, report
from wardrisk.sources import readers

NEWS = [("Tandes", 2), ("Semampir", 4), ("Sukolilo", 1), ("Wiyung", 1)]
CASES = [("Semampir", 513279), ("Kenjeran", 543956), ("Krembangan", 354135), ("Bubutan", 253719)]
FACILITIES = [("Semampir", 801), ("Kenjeran", 641), ("Krembangan", 667), ("Bubutan", 526), ("Mulyorejo", 2185)]


@pytest.fixture(scope="module")
def inputs(spark):
    base = readers.crime_baseline(spark)
    news = spark.createDataFrame([(k, n, 0) for k, n in NEWS],
                                 "kecamatan string, total_kasus_berita_kriminal long, total_kasus_berita_wabah long")
    disease = spark.createDataFrame(CASES, "kecamatan string, kasus_wabah_baseline long")
    facilities = spark.createDataFrame(FACILITIES, "kecamatan string, total_faskes long")
    return base, news, disease, facilities


@pytest.fixture(scope="module")
def crime(inputs):
    return index.crime_index(inputs[0], inputs[1]).cache()


@pytest.fixture(scope="module")
def health(inputs):
    base, news, disease, facilities = inputs
    return index.health_index(base, disease, facilities, news).cache()


def test_crime_golden(crime):
    got = {r.kecamatan: (r.crime_rate, r.indeks_kriminalitas) for r in crime.collect()}
    assert len(got) == 31
    assert got["Tandes"] == (192.84406868299487, 100.0)
    assert got["Kenjeran"] == (178.6450460354542, 92.60395738998004)
    assert got["Asemrowo"] == (171.98665055998035, 89.13570623823628)
    assert got["Semampir"] == (171.40826522293526, 88.83443461525333)
    assert got["Jambangan"] == (164.1702943997639, 85.06429198311037)


def test_health_golden(health):
    got = {r.kecamatan: r for r in health.collect()}
    assert got["Semampir"].incidence_rate == 1072930.0361629634
    assert got["Semampir"].hfr == 167.436610297038
    want = {"Semampir": 79.72047623696626, "Kenjeran": 77.62451299202552, "Krembangan": 43.08123982033196,
            "Bubutan": 40.52937230708142}
    for name, value in want.items():
        assert got[name].indeks_kesehatan == pytest.approx(value, abs=1e-11)


def test_dual_index_equals_both(inputs, crime, health, rows):
    base, news, disease, facilities = inputs
    dual = index.dual_index(base, [news, disease, facilities])
    table = index.risk_table(crime, health)
    assert rows(dual.select(*table.columns)) == rows(table)


def test_zero_population_and_missing_news(spark):
    base = spark.createDataFrame([("A", 5, 100), ("B", 7, 0), ("C", 1, None), ("D", 0, 50)],
                                 "kecamatan string, jumlah_kasus int, jumlah_penduduk int")
    news = spark.createDataFrame([("Z", 9)], "kecamatan string, total_kasus_berita_kriminal long")
    got = {r.kecamatan: r.indeks_kriminalitas for r in index.crime_index(base, news).collect()}
    assert got == {"A": 100.0, "B": None, "C": None, "D": 0.0}


def test_minmax_empty_range_and_groups(spark):
    df = spark.createDataFrame([("x", 3.0), ("x", 3.0), ("y", 1.0), ("y", 2.0), (None, 5.0), (None, 9.0)], "g string, v double")
    assert {r.o for r in index.minmax(df.filter("g = 'x'"), {"v": "o"}).collect()} == {0.0}
    got = sorted((str(r.g), r.v, r.o) for r in index.minmax(df, {"v": "o"}, by="g").collect())
    assert got == [("None", 5.0, 0.0), ("None", 9.0, 100.0), ("x", 3.0, 0.0), ("x", 3.0, 0.0), ("y", 1.0, 0.0), ("y", 2.0, 100.0)]


def test_rank_matches_plain_order(spark):
    values = [("k%02d" % i, v) for i, v in enumerate([0.0, 100.0, 50.5, 50.4, 50.4, None, 99.99, 100.0, 0.0, -5.0, 140.0])]
    df = spark.createDataFrame(values, "k string, v double")
    want = [k for k, _ in sorted(values, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))]
    ranked = rank.rank_desc(df, "v", "k").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(values) + 1))
    assert [r.k for r in ranked] == want
    numbered = rank.number_rows(df, [F.col("v").desc_nulls_last(), F.col("k").asc()], "n").orderBy("n").collect()
    assert [(r.k, r.n) for r in numbered] == list(zip(want, range(len(values))))


def test_top_bottom_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", 0.5), ("e", 0.5)], "k string, v double")
    assert [r.k for r in rank.top_n(df, "v", 2, "k").collect()] == ["b", "c"]
    assert [r.k for r in rank.bottom_n(df, "v", 2, "k").collect()] == ["e", "d"]
    assert rank.worst_best(df, "v", "k").first().asDict() == {"worst": "b", "worst_value": 3.0, "best": "e", "best_value": 0.5}


def test_histogram_keeps_empty_bands(spark):
    df = spark.createDataFrame([(80.0,), (80.1,), (20.0,), (None,)], "v double")
    got = {r.band: r.n for r in rank.band_histogram(df, "v", fixed.CRIME_ZONES).collect()}
    assert got == {"Ekstrim (>80)": 1, "Tinggi (60-80)": 1, "Sedang (40-60)": 0, "Waspada (20-40)": 1, "Aman (<20)": 0}


def test_city_history_change(spark):
    from wardrisk.operators.reshape import trend_change

    change = trend_change(readers.city_history(spark), "tahun", "jumlah").first()
    assert (change.first_value, change.last_value, change.change_percent) == (3377, 8759, 159.0)


def test_number_rows_splits_one_hot_value(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    got = rank.number_rows(df, order, "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(20000))
    assert [r.id for r in got] == sorted(range(20000), key=lambda i: (-(i if i % 3 == 0 else -1), i))
    parts = df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 20000 / 3


def test_products(crime, health, spark):
    risk = index.risk_table(crime, health).cache()
    summary = report.city_summary(risk).first()
    assert (summary.worst_crime, summary.best_crime, summary.worst_health, summary.districts) == ("Tandes", "Sukolilo", "Semampir", 31)
    assert summary.total_crime == sum(r[1] for r in fixed.CRIME_BASELINE) + 8
    rep = {r.kecamatan: r for r in report.risk_report(risk).collect()}
    assert rep["Tandes"].risk_level == "EKSTRIM" and rep["Tandes"].crime_rank == 1
    assert rep["Tandes"].priority == fixed.PRIORITY_CRIME
    assert rep["Semampir"].health_rank == 1 and rep["Semampir"].hfr_shown == "16743.66%"
    profile = {r.kecamatan: r for r in report.profile(risk).collect()}
    assert profile["Kenjeran"].crime_rank == 2 and profile["Kenjeran"].crime_step == "4"
    context = {r.kecamatan: r.context for r in report.district_context(risk).collect()}
    assert context["Tandes"].startswith("Kriminalitas: indeks=100.0/100, total_kasus=177, crime_rate=192.8\nKesehatan: ")
    city = report.city_context(risk).first()
    assert city.top_crime == "Tandes(100.0), Kenjeran(92.6), Asemrowo(89.1)"
    compared = {r.figure: r for r in report.compare(risk, "kecamatan tandes", "Semampir").collect()}
    assert (compared["indeks_kriminalitas"].mark_a, compared["indeks_kriminalitas"].mark_b) == ("▲", "▼")
    assert compared["crime_rate"].mark_a is None


def test_product_with_one_sided_district(spark):
    crime = spark.createDataFrame([("A", 1, 2.0, 100.0)], "kecamatan string, total_kasus_kriminal long, crime_rate double, indeks_kriminalitas double")
    health = spark.createDataFrame([("B", 1, 2.0, 3.0, 50.0)], "kecamatan string, total_kasus_wabah long, incidence_rate double, hfr double, indeks_kesehatan double")
    risk = index.risk_table(crime, health)
    got = {r.kecamatan: (r.crime_rank, r.health_rank) for r in report.ranked(risk).collect()}
    assert got == {"A": (1, 0), "B": (0, 1)}
    assert [tuple(r) for r in report.dual_recap(risk).collect()] == [("A", 100.0, 0.0)]


def test_multiplier_without_news(spark):
    base = spark.createDataFrame([("A", 10)], "k string, cases long")
    counts = spark.createDataFrame([("Z", 1)], "k string, news long")
    assert index.news_multiplier(base, counts, "k", "cases", "news", 0.5, "o").first().o == 10
