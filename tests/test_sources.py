import json

import pytest
from pyspark.sql import functions as F

from wardrisk.functions import fixed
from wardrisk.operators import reshape
from wardrisk.sources import readers, writers


def test_baseline_schema(spark):
    df = readers.crime_baseline(spark)
    assert df.count() == 31 and df.schema == readers.CRIME_SCHEMA
    assert df.filter("kecamatan = 'Tandes'").first().jumlah_kasus == 175


def test_read_or_empty(spark, tmp_path):
    schema = readers.CRIME_SCHEMA
    empty = readers.read_or_empty(spark, f"{tmp_path}/none", schema)
    assert empty.count() == 0 and empty.columns == schema.names
    assert not readers.table_exists(spark, f"{tmp_path}/none")
    writers.overwrite(readers.crime_baseline(spark), f"{tmp_path}/t")
    assert readers.table_exists(spark, f"{tmp_path}/t")
    assert readers.read_or_empty(spark, f"{tmp_path}/t", schema).count() == 31
    with pytest.raises(Exception, match="nosuchformat"):
        readers.read_or_empty(spark, f"{tmp_path}/t", schema, "nosuchformat")


def test_overwrite_checked_refuses_a_new_schema(spark, tmp_path):
    path = f"{tmp_path}/gold"
    writers.overwrite_checked(spark.createDataFrame([(1,)], "a int"), path)
    writers.overwrite_checked(spark.createDataFrame([(2,)], "a int"), path)
    with pytest.raises(ValueError):
        writers.overwrite_checked(spark.createDataFrame([("2",)], "a string"), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2,)]


def test_delimited_with_lineage(spark, tmp_path):
    (tmp_path / "f.csv").write_text("kecamatan;nama;n\nPakal;A, B;1\n", encoding="utf-8")
    df = readers.with_lineage(readers.read_delimited(spark, str(tmp_path)))
    row = df.first()
    assert (row.kecamatan, row.nama, row.n, row.bronze_source_file) == ("Pakal", "A, B", 1, "f.csv")
    named = readers.with_lineage(readers.read_delimited(spark, str(tmp_path), "kecamatan string, nama string, n string"), "given.csv")
    assert named.first().bronze_source_file == "given.csv"


def test_period_files(spark, tmp_path, rows):
    head = "﻿_id,Kecamatan,Difteri,Suspek Campak\n"
    for name, body in (("a.csv", "1,Pakal,0,2\n"), ("a", "1,Pakal,0,2\n"), ("b.csv", "1,Pakal,3,4\n")):
        (tmp_path / name).write_text(head + body, encoding="utf-8")
    df = readers.read_periods(spark, str(tmp_path), "_id int, Kecamatan string, Difteri int, `Suspek Campak` int")
    assert sorted((r.Kecamatan, r.Difteri, r["Suspek Campak"], r.source_file[0]) for r in df.collect()) == [("Pakal", 0, 2, "a"), ("Pakal", 3, 4, "b")]
    copies = sorted(r.copies for r in readers.distinct_files(spark, str(tmp_path)).collect())
    assert copies == [1, 2]


def test_equal_files_of_two_periods_stay(spark, tmp_path):
    for name in ("2023.csv", "2024.csv", "2024"):
        (tmp_path / name).write_text("k,n\nPakal,1\n", encoding="utf-8")
    rows = readers.read_periods(spark, str(tmp_path), "k string, n int").collect()
    assert sorted((r.k, r.n, r.period) for r in rows) == [("Pakal", 1, "2023"), ("Pakal", 1, "2024")]


def test_report_row_with_an_empty_year(spark):
    lines = spark.createDataFrame([("r", 1, "Kota", None, None), ("r", 2, "A", "5", None), ("r", 3, "B", None, None)],
                                  "report string, line long, c0 string, c2 string, c3 string")
    long = reshape.report_rows(lines, "report", "line", "c0", {"c2": "2019", "c3": "2020"}, {"Kota": "city"})
    assert [(r.c0, r.tahun, r.jumlah) for r in long.collect()] == [("A", "2019", 5.0)]


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("""<?xml version="1.0" encoding="UTF-8"?><rss><channel><title>Feed</title>
      <item><title>Begal di Tandes - detik.com</title><link>https://e.org/1?a=1&amp;b=2</link><pubDate>Mon, 23 Jun 2025 12:00:00 GMT</pubDate>
        <description>&lt;a href="x"&gt;Begal&lt;/a&gt;&amp;nbsp;&lt;font&gt;detik&lt;/font&gt;</description><source url="https://d">Detik</source></item>
      <item><title>No source - Kompas</title><link>https://e.org/2</link></item>
      <item><title>Search</title><link>https://news.google.com/search?q=1</link></item>
      <item><title>No link</title></item></channel></rss>""", encoding="utf-8")
    now = F.lit("2025-07-01 00:00:00").cast("timestamp")
    got = {r.judul: r for r in readers.feed_items(readers.read_feed(spark, str(tmp_path)), "Kriminalitas", now).collect()}
    assert set(got) == {"Begal di Tandes - detik.com", "No source - Kompas"}
    first, second = got["Begal di Tandes - detik.com"], got["No source - Kompas"]
    assert (first.link, first.sumber, first.tanggal_publikasi, first.deskripsi_mentah) == (
        "https://e.org/1?a=1&b=2", "Detik", "2025-06-23T12:00:00", "Begal detik")
    assert (second.sumber, second.tanggal_publikasi, second.deskripsi_mentah) == ("Kompas", "2025-07-01T00:00:00", "")
    assert len(first.id_berita) == 16 and first.kategori == "Kriminalitas"


REPORT = '''﻿"Kriminalitas, 2019-2020",,,,
"Kabupaten/Kota
Regency/Municipality",,Jumlah,,
,,2019,2020,
Kabupaten/Regency,,,,
Pacitan,,108,72,
Kediri,,1159,"1,862",
Kota/Municipality,,,,
Kediri,,875,558,
Jawa Timur,,"2,142","2,492",
"Catatan/Note: x
Sumber: y",,,,
'''


def test_report_sheet(spark, tmp_path):
    (tmp_path / "r.csv").write_text(REPORT, encoding="utf-8")
    cells = readers.read_report(spark, str(tmp_path), 5)
    long = reshape.report_rows(cells, "report", "line", "c0", {"c2": "2019", "c3": "2020"},
                               {"Kabupaten/Regency": "regency", "Kota/Municipality": "municipality"}, ["Jawa Timur"])
    got = sorted((r.section, r.c0, r.tahun, r.jumlah) for r in long.collect())
    assert got == [("municipality", "Kediri", "2019", 875.0), ("municipality", "Kediri", "2020", 558.0),
                   ("regency", "Kediri", "2019", 1159.0), ("regency", "Kediri", "2020", 1862.0),
                   ("regency", "Pacitan", "2019", 108.0), ("regency", "Pacitan", "2020", 72.0)]


def test_html_envelope(spark, tmp_path):
    table = "&lt;html&gt;&lt;style&gt;td{}&lt;/style&gt;&lt;TABLE&gt;&lt;tr&gt;&lt;td class=&quot;x&quot;&gt;Pacitan&lt;/td&gt;&lt;td&gt;1,787 &lt;b&gt;!&lt;/b&gt;&lt;/td&gt;&lt;/tr&gt;\r\n&lt;tr&gt;&lt;th&gt;A &amp;amp; B&lt;/th&gt;&lt;/tr&gt;&lt;/TABLE&gt;"
    (tmp_path / "e.json").write_text(json.dumps({"status": "OK", "data": {"table_id": 1, "title": "t", "table": table}}, indent=1))
    rows = readers.html_table_rows(readers.read_envelope(spark, str(tmp_path)), "table", ["table_id"])
    assert [(r.table_id, r.row, r.cells) for r in rows.orderBy("row").collect()] == [(1, 0, ["Pacitan", "1,787 !"]), (1, 1, ["A & B"])]


def gold(spark):
    crime = spark.createDataFrame([("A", 3, 1.234, 50.0), ("B", 9, 9.0, 100.0), ("C", 1, None, None)],
                                  "kecamatan string, total_kasus_kriminal long, crime_rate double, indeks_kriminalitas double")
    health = spark.createDataFrame([("A", 3, 1.0, 2.0, 7.0)], "kecamatan string, total_kasus_wabah long, incidence_rate double, hfr double, indeks_kesehatan double")
    news = spark.createDataFrame([("1", "t1", "2025-01-01 00:00:00", "A"), ("2", "t2", None, "A"), ("3", "t3", "2025-01-02 00:00:00", "B"), ("4", "t4", "2025-01-03 00:00:00", "unknown")],
                                 "id_berita string, judul string, ts string, kecamatan_terdeteksi string")
    news = news.select("id_berita", "judul", F.lit("l").alias("link"), F.col("ts").cast("timestamp").alias("tanggal_publikasi"), F.lit("s").alias("sumber"),
                       F.lit("k").alias("kategori"), "kecamatan_terdeteksi", F.lit("d").alias("deskripsi_mentah"))
    return crime, health, news


def test_document_round_trip(spark, tmp_path):
    doc = writers.publish(*gold(spark), n=3, last_updated="2025-02-01T00:00:00")
    assert doc.count() == 1
    writers.write_document(doc, f"{tmp_path}/doc")
    parts = readers.read_document(spark, f"{tmp_path}/doc")
    assert [r.kecamatan for r in parts["kriminalitas"].orderBy("position").collect()] == ["B", "A", "C"]
    assert [(r.id_berita, r.tanggal_publikasi) for r in parts["berita"].orderBy("position").collect()] == [
        ("3", "2025-01-02T00:00:00"), ("1", "2025-01-01T00:00:00"), ("2", None)]
    text = spark.read.text(f"{tmp_path}/doc").first().value
    assert json.loads(text)["last_updated"] == "2025-02-01T00:00:00"
    assert {r.section for r in writers.publish_rows(*gold(spark), n=1).collect()} == {"kriminalitas", "kesehatan", "berita"}


def test_document_lists_the_first_districts(spark):
    doc = writers.publish(*gold(spark), n=1, districts=2).first()
    assert [r.kecamatan for r in doc.kriminalitas] == ["B", "A"]
    assert [r.id_berita for r in doc.berita] == ["3"]


def test_document_lists_every_district(spark, tmp_path):
    from wardrisk.plans import medallion

    layout = medallion.Layout(f"{tmp_path}/lake")
    crime = spark.range(1500).select(F.format_string("d%04d", "id").alias("kecamatan"), F.col("id").alias("total_kasus_kriminal"),
                                     F.lit(1.0).alias("crime_rate"), F.col("id").cast("double").alias("indeks_kriminalitas"))
    writers.overwrite(crime, layout.gold("tbl_index_kriminalitas"))
    writers.overwrite(gold(spark)[1], layout.gold("tbl_index_kesehatan"))
    medallion.export_document(spark, layout, f"{tmp_path}/doc")
    listed = readers.read_document(spark, f"{tmp_path}/doc")["kriminalitas"].orderBy("position").collect()
    assert [(r.position, r.kecamatan) for r in listed] == [(i, f"d{1499 - i:04d}") for i in range(1500)]
    rows = spark.read.json(f"{tmp_path}/doc_rows").where("section = 'kriminalitas'").collect()
    assert sorted((r.position, r.key) for r in rows) == [(i, f"d{1499 - i:04d}") for i in range(1500)]


def test_published_rows_have_their_position(spark):
    values = [(f"d{i:02d}", i, 1.0, v) for i, v in enumerate([9.5, 100.0, 10.0, None, 10.0])]
    crime = spark.createDataFrame(values, "kecamatan string, total_kasus_kriminal long, crime_rate double, indeks_kriminalitas double")
    rows = writers.publish_rows(crime, *gold(spark)[1:], n=2).collect()
    assert sorted((r.position, r.key) for r in rows if r.section == "kriminalitas") == [
        (0, "d01"), (1, "d02"), (2, "d04"), (3, "d00"), (4, "d03")]
    assert sorted((r.position, r.key) for r in rows if r.section == "berita") == [(0, "3"), (1, "1")]


def test_csv_file_text(spark, tmp_path):
    crime = gold(spark)[0].filter("kecamatan <> 'C'").coalesce(1)
    writers.write_csv(crime, f"{tmp_path}/c", {"kecamatan": "Kecamatan", "crime_rate": "Crime Rate"}, decimals=("crime_rate",))
    part = next(p for p in (tmp_path / "c").iterdir() if p.suffix == ".csv")
    assert part.read_bytes().decode("utf-8").splitlines() == ['﻿"Kecamatan","Crime Rate"', '"A","1.23"', '"B","9.00"']


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([("i1", "é", None)], "id_berita string, judul string, link string")
    writers.publish_messages(df, "topic", fmt="parquet", path=f"{tmp_path}/m")
    row = spark.read.parquet(f"{tmp_path}/m").first()
    assert bytes(row.key) == b"i1" and json.loads(bytes(row.value)) == {"id_berita": "i1", "judul": "é", "link": None}


def test_statistics(spark):
    items = spark.createDataFrame([("https://e.org/1",), ("https://e.org/1",), ("https://e.org/2",), ("",), (None,)], "link string")
    seen = items.filter("link = 'https://e.org/2'").select(F.substring(F.sha2("link", 256), 1, 16).alias("id_berita"))
    assert tuple(readers.ingest_statistics(items, seen).first()) == (5, 3, 2, 1, 0, 1)
    told = items.withColumns({"error": F.when(F.col("link") == "", "no answer"), "cycle": F.length("link")})
    assert tuple(readers.ingest_statistics(told, seen, "error", "cycle").first()) == (4, 3, 2, 1, 1, 2)


def test_scratch_folder_is_under_the_checkpoint_folder(spark):
    assert writers.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fixed_values():
    assert len(fixed.DISTRICTS) == 31 and len(fixed.TOPIC_STOPWORDS) == len(set(fixed.TOPIC_STOPWORDS))
    assert {name.lower() for name, *_ in fixed.CRIME_BASELINE} == set(fixed.DISTRICTS) == set(fixed.DISTRICT_FIGURES)


def test_document_of_lines_is_one_json_object(spark, tmp_path):
    """The files in the order of their names are the document; positions come back from the order of the lines."""
    import json

    crime = spark.range(5000).select(F.format_string("d%05d", "id").alias("kecamatan"), F.col("id").alias("total_kasus_kriminal"),
                                     (F.col("id") / 7).alias("crime_rate"), (F.col("id") % 100 / 1.0).alias("indeks_kriminalitas"))
    _, health, news = gold(spark)
    rows = writers.publish_rows(crime, health, news, n=3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the list is small, but has to come in several files
    writers.write_document_lines(writers.document_lines(rows, "2025-02-01T00:00:00"), f"{tmp_path}/doc")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "doc").glob("part=*/part-*"))
    doc = json.loads("".join(f.read_text() for f in files))
    assert list(doc) == ["last_updated", "kriminalitas", "kesehatan", "berita"] and len(files) > 7
    want = sorted(range(5000), key=lambda i: (-(i % 100), i))
    assert [r["kecamatan"] for r in doc["kriminalitas"]] == [f"d{i:05d}" for i in want]
    parts = readers.read_document(spark, f"{tmp_path}/doc")
    assert [tuple(r) for r in parts["kriminalitas"].select("position", "kecamatan").orderBy("position").collect()] == [
        (p, f"d{i:05d}") for p, i in enumerate(want)]
    assert parts["kesehatan"].count() == health.count() and parts["berita"].count() == len(doc["berita"])


def test_document_of_lines_without_rows(spark, tmp_path):
    import json

    crime, health, news = (df.limit(0) for df in gold(spark))
    writers.write_document_lines(writers.document_lines(writers.publish_rows(crime, health, news), "now"), f"{tmp_path}/doc")
    doc = json.loads("".join(f.read_text() for f in sorted((tmp_path / "doc").glob("part=*/part-*"))))
    assert doc == {"last_updated": "now", "kriminalitas": [], "kesehatan": [], "berita": []}
    assert readers.read_document(spark, f"{tmp_path}/doc")["berita"].count() == 0
