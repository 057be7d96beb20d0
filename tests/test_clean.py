import datetime as dt
import json

from pyspark.sql import functions as F

from wardrisk.operators import clean


def test_clean_table(spark, rows):
    df = spark.createDataFrame([(" ASEMROWO ", "a", "5"), (" ASEMROWO ", "a", "5"), ("pakal", "b", "x"), (None, "c", "1"), ("d", None, "1")],
                               "kecamatan string, nama string, n string")
    out = clean.clean_table(df, ["kecamatan", "nama"], ["kecamatan"], {"n": "int"})
    assert rows(out) == [("Asemrowo", "a", 5), ("Pakal", "b", None)]
    assert clean.clean_table(df, dedup=False).count() == 5


def test_parse_news_keeps_malformed(spark):
    good = json.dumps({"id_berita": "1", "judul": "t", "tanggal_publikasi": "2025-01-01T00:00:00", "ingested_at": "x"})
    rfc = json.dumps({"id_berita": "2", "tanggal_publikasi": "Mon, 01 Jan 2025 00:00:00 GMT"})
    stamp = dt.datetime(2025, 1, 2)
    df = spark.createDataFrame([(good, stamp), (rfc, stamp), ('{"id_', stamp), (None, stamp)], "raw_value string, kafka_timestamp timestamp")
    out = clean.parse_news(df)
    assert out.columns == ["id_berita", "judul", "link", "tanggal_publikasi", "sumber", "kategori", "deskripsi_mentah", "kafka_timestamp"]
    got = [(r.id_berita, r.tanggal_publikasi) for r in out.collect()]
    assert got == [("1", dt.datetime(2025, 1, 1)), ("2", None), (None, None), (None, None)]


def news(spark):
    d = dt.datetime
    return spark.createDataFrame([
        ("1", "Begal di Tandes", "Kriminalitas", "Tandes", d(2025, 1, 10)), ("2", "DBD naik", "Kesehatan", "Pakal", d(2025, 1, 1)),
        ("3", "Begal lagi", "Kriminalitas", "unknown", None)],
        "id_berita string, judul string, kategori string, kecamatan_terdeteksi string, tanggal_publikasi timestamp")


def test_news_filter(spark):
    df = news(spark)

    def ids(**options):
        return sorted(r.id_berita for r in clean.news_filter(df, **options).collect())
    assert ids() == ["1", "2", "3"]
    assert ids(search=" BEGAL ") == ["1", "3"]
    assert ids(category="Kesehatan") == ["2"]
    assert ids(place="kecamatan tandes") == ["1"]
    assert ids(days=9, as_of="2025-01-10") == ["1", "2"]
    assert ids(days=8, as_of="2025-01-10") == ["1"]
    assert sorted(r.id_berita for r in clean.exclude_value(df, "kecamatan_terdeteksi").collect()) == ["1", "2"]


def test_find_place(spark):
    df = spark.createDataFrame([("Kecamatan Wonocolo", 1.0), ("Wonokromo", 2.0)], "k string, v double")
    assert clean.find_place(df, "k", "Wono", "v").first().k == "Wonokromo"
    assert clean.find_place(df, "k", "wonoc", "v").first().k == "Kecamatan Wonocolo"
    assert clean.find_place(df, "k", " ", "v").count() == 0


def test_dedup_and_new_items(spark, rows):
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, 2), 2), ("a", dt.datetime(2025, 1, 1), 1), ("b", None, 3)],
                               "id_berita string, kafka_timestamp timestamp, n int")
    assert rows(clean.dedup_news(df), "id_berita", "n") == [("a", 1), ("b", 3)]
    seen = spark.createDataFrame([("b",), ("b",), ("z",)], "id_berita string")
    assert rows(clean.new_items(df, seen, ["id_berita"]), "id_berita") == [("a",)]
    links = spark.createDataFrame([("", "t"), (None, "u"), ("l", "v")], "link string, judul string")
    assert [r.i for r in links.select(clean.news_identity().alias("i")).collect()] == ["t", "u", "l"]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = clean.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
