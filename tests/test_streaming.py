import datetime as dt
import json


from wardrisk.operators.clean import NEWS_SCHEMA
from wardrisk.plans import medallion
from wardrisk.sources import readers
from wardrisk.streaming import news as streams


def message(i, place="tandes", **extra):
    body = {"id_berita": f"n{i}", "judul": f"Berita {i} di {place}", "link": f"https://e.org/{i}",
            "tanggal_publikasi": "2025-01-01T00:00:00", "sumber": "s", "kategori": "Kriminalitas", "deskripsi_mentah": "polisi begal", **extra}
    return (f"n{i}".encode(), json.dumps(body).encode(), "news", 0, i, dt.datetime(2025, 1, 1, 0, i % 60))


def land(spark, path, messages):
    spark.createDataFrame(messages, streams.ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return streams.open_stream(spark, "parquet", path, streams.ENVELOPE)


def test_stream_equals_batch_and_resumes(spark, tmp_path, rows):
    layout, landed = medallion.Layout(f"{tmp_path}/lake"), f"{tmp_path}/topic"
    assert medallion.clean_news_stream(spark, layout) is None  # no raw news yet: not an error
    land(spark, landed, [message(1), message(2, "gunung-anyar"), (b"x", b"{broken", "news", 0, 3, dt.datetime(2025, 1, 1))])
    medallion.ingest_news(source(spark, landed), layout)
    medallion.clean_news_stream(spark, layout)
    land(spark, landed, [message(4, "entah")])
    for _ in range(2):  # the second drain finds nothing new
        medallion.ingest_news(source(spark, landed), layout)
        medallion.clean_news_stream(spark, layout)
    stream = readers.read_table(spark, layout.silver("tbl_clean_news"))
    assert [f.name for f in stream.schema] == NEWS_SCHEMA.names
    batch = streams.clean_news(streams.envelope(spark.read.schema(streams.ENVELOPE).parquet(landed)))
    keep = [c for c in stream.columns if c != "silver_processed_at"]
    assert rows(stream, *keep) == rows(batch, *keep)
    assert rows(stream, "id_berita", "kecamatan_terdeteksi") == [("n1", "Tandes"), ("n2", "Gunung Anyar"), ("n4", "unknown"), (None, "unknown")]


def test_partitioned_tables(spark, tmp_path, rows):
    layout = medallion.Layout(f"{tmp_path}/lake")
    land(spark, f"{tmp_path}/t", [message(1), message(2, "pakal")])
    medallion.ingest_news(source(spark, f"{tmp_path}/t"), layout, by_date=True)
    medallion.clean_news_stream(spark, layout, by_place=True)
    assert (tmp_path / "lake/bronze/tbl_raw_news/kafka_date=2025-01-01").is_dir()
    pakal = readers.read_table(spark, layout.silver("tbl_clean_news")).filter("kecamatan_terdeteksi = 'Pakal'")
    assert rows(pakal, "id_berita") == [("n2",)]
    assert "PartitionFilters: [isnotnull(kecamatan_terdeteksi" in pakal._jdf.queryExecution().executedPlan().toString()


def test_non_blocking_start(spark, tmp_path):
    land(spark, f"{tmp_path}/t", [message(1)])
    query = streams.drain(streams.envelope(source(spark, f"{tmp_path}/t")), f"{tmp_path}/o", f"{tmp_path}/c", block=False)
    query.awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/o").count() == 1


def test_dedup_across_batches_and_restart(spark, tmp_path):
    schema = "id string, ts timestamp"

    def put(*ids, month=3):
        spark.createDataFrame([(i, dt.datetime(2025, month, 1)) for i in ids], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        df = streams.open_stream(spark, "parquet", f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        streams.dedup_stream(df, ["id"], f"{tmp_path}/out", f"{tmp_path}/seen", f"{tmp_path}/c").awaitTermination()

    put("a", "a", "b", None, None)
    run()
    put("a", "c")
    run()
    put("old but unique", "b", None, month=1)  # long before everything seen so far
    run()
    assert sorted(r.id or "" for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["", "", "", "a", "b", "c", "old but unique"]


def test_refresh_only_for_new_keys(spark, tmp_path):
    calls = []

    def put(*ids):
        spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run(checkpoint="c"):
        df = streams.open_stream(spark, "parquet", f"{tmp_path}/in", spark.createDataFrame([], "id string").schema)
        streams.refresh_on_new(df, f"{tmp_path}/seen", f"{tmp_path}/{checkpoint}", ["id"],
                               lambda fresh, batch: calls.append((batch, sorted(r.id for r in fresh.collect())))).awaitTermination()

    put("a", "b", "a")
    run()
    put("a")
    run()
    put("b", "c")
    run()
    assert calls == [(0, ["a", "b"]), (2, ["c"])]
    # Another stream with the same table of seen keys: nothing is new, and the first stream's entries stay.
    calls.clear()
    run("another")
    assert calls == []
    put("d")
    run("another")
    run()
    assert [keys for _, keys in calls] == [["d"]]


def test_a_batch_that_runs_again_gives_the_same_rows(spark, tmp_path):
    """As after a failure between the output and the commit: the checkpoint is lost, the seen keys are there."""
    import shutil

    spark.createDataFrame([("a",), ("b",)], "id string").write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        df = streams.open_stream(spark, "parquet", f"{tmp_path}/in", spark.createDataFrame([], "id string").schema)
        streams.dedup_stream(df, ["id"], f"{tmp_path}/out", f"{tmp_path}/seen", f"{tmp_path}/c").awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]
        shutil.rmtree(tmp_path / "c")


def facility(i, name="ASEMROWO"):
    return f"35;JATIM;3578;SURABAYA;1;1;{name};Puskesmas;Dinas;F{i};1;2025"


def disease(i, cases, name=" asemrowo "):
    return f"35;JATIM;3578;SURABAYA;1;1;{name};F{i};DBD;{cases};1;2025"


def test_whole_job(spark, tmp_path):
    head = "kode_provinsi;nama_provinsi;kode_kota;nama_kota;kode_kecamatan_kemendagri;kode_kecamatan_bps;kecamatan"
    (tmp_path / "f.csv").write_text("\n".join([head + ";jenis_faskes;penyelenggara_faskes;nama_faskes;periode;tahun",
                                               facility(1), facility(1), facility(2), facility(3, "Darmo")]))
    (tmp_path / "d.csv").write_text("\n".join([head + ";nama_faskes;jenis_penyakit;jumlah_kasus;periode;tahun", disease(1, 10), disease(2, "x"), disease(3, 5, "Pakal")]))
    layout = medallion.Layout(f"{tmp_path}/lake")
    counts = medallion.ingest_batch(spark, layout, str(tmp_path / "f.csv"), str(tmp_path / "d.csv"))
    assert counts == {"tbl_raw_faskes_baseline": 4, "tbl_raw_disease_baseline": 3, "tbl_static_crime_baseline": 31}
    medallion.clean_batch(spark, layout)
    assert readers.read_table(spark, layout.silver("tbl_clean_faskes")).count() == 3
    assert not medallion.build_gold(spark, layout, strict=True)  # no news: the strict rule writes nothing
    assert not readers.table_exists(spark, layout.gold("tbl_index_kriminalitas"))

    land(spark, f"{tmp_path}/topic", [message(i, "tandes" if i % 2 else "semampir") for i in range(10)] + [message(3)])
    medallion.ingest_news(source(spark, f"{tmp_path}/topic"), layout)
    medallion.clean_news_stream(spark, layout)
    assert medallion.build_gold(spark, layout, dedup=True, partitions=2)
    crime = {r.kecamatan: r for r in readers.read_table(spark, layout.gold("tbl_index_kriminalitas")).collect()}
    health = {r.kecamatan: r for r in readers.read_table(spark, layout.gold("tbl_index_kesehatan")).collect()}
    assert len(crime) == len(health) == 31
    news = sum(r.total_kasus_berita_kriminal for r in crime.values()) + sum(r.total_kasus_berita_wabah for r in health.values())
    assert news == 10
    assert (health["Asemrowo"].kasus_wabah_baseline, health["Asemrowo"].total_faskes) == (10, 2)
    unmatched = readers.read_table(spark, layout.gold("unmatched_keys")).collect()
    assert [(r.kecamatan, r.table_name) for r in unmatched] == [("Darmo", "tbl_clean_faskes")]
    medallion.export_document(spark, layout, f"{tmp_path}/doc", 5)
    parts = readers.read_document(spark, f"{tmp_path}/doc")
    assert {k: v.count() for k, v in parts.items()} == {"kriminalitas": 31, "kesehatan": 31, "berita": 5}
    report = {r.table_name: r for r in medallion.verify_layer(spark, {"crime": layout.gold("tbl_index_kriminalitas"), "no": layout.gold("no")}).collect()}
    assert (report["crime"].rows, report["crime"].columns, report["no"].present) == (31, 8, False)
    # Without news the baselines still give indices.
    other = medallion.Layout(f"{tmp_path}/lake2")
    medallion.ingest_batch(spark, other, str(tmp_path / "f.csv"), str(tmp_path / "d.csv"))
    medallion.clean_batch(spark, other)
    assert medallion.build_gold(spark, other)
    assert readers.read_table(spark, other.gold("tbl_index_kriminalitas")).filter("total_kasus_berita_kriminal <> 0").count() == 0


def test_a_batch_costs_the_same_however_many_came_before(spark, tmp_path):
    """Fifty batches with as many new keys each: every one reads its own rows only, and the state gets their keys."""
    for i in range(50):
        spark.createDataFrame([(f"k{i}-{j}",) for j in range(20)] + [("k0-0",)], "id string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    files = streams.open_stream(spark, "parquet", f"{tmp_path}/in", spark.createDataFrame([], "id string").schema, maxFilesPerTrigger=1)
    query = streams.dedup_stream(files, ["id"], f"{tmp_path}/out", None, f"{tmp_path}/c")
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p.numInputRows]
    # The one source feeds two branches: the rows, and their keys for the state.
    assert len(steps) == 50 and {sum(s.numInputRows for s in p.sources) for p in steps} == {42}
    states = [p.stateOperators[0] for p in steps]
    assert [s.numRowsTotal for s in states] == [20 * (i + 1) for i in range(50)]
    assert {s.numRowsUpdated for s in states[1:]} == {21}
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.distinct().count() == 1000
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != streams.STATE_SETTINGS["spark.sql.streaming.stateStore.providerClass"]


def test_statistics_of_a_stream_equal_the_batch_table(spark, tmp_path):
    """Two cycles with repeats, a failed fetch in each, and items without an identity."""
    cycles = [[("https://e.org/1", None), ("https://e.org/2", None), ("https://e.org/1", None), (None, "timeout")],
              [("https://e.org/2", None), ("https://e.org/3", None), ("https://e.org/9", "refused"), ("https://e.org/4", None)]]
    listener = streams.IngestStatistics()
    spark.streams.addListener(listener)
    try:
        for cycle in cycles:
            spark.createDataFrame(cycle, "link string, error string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            df = streams.open_stream(spark, "parquet", f"{tmp_path}/in", spark.createDataFrame([], "link string, error string").schema)
            query = streams.dedup_stream(df, ["link"], f"{tmp_path}/out", None, f"{tmp_path}/c", error="error")
            query.awaitTermination()
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    table = listener.table(spark).collect()
    assert [(r.batch, r.fetched, r.duplicates, r.sent, r.errors) for r in table] == [(0, 3, 1, 2, 1), (1, 3, 1, 2, 1)]
    rows = spark.createDataFrame([(*r, i) for i, c in enumerate(cycles) for r in c], "link string, error string, cycle int")
    whole = readers.ingest_statistics(rows, spark.createDataFrame([], "id_berita string"), "error", "cycle").first()
    assert (whole.fetched, whole.duplicates, whole.sent, whole.errors, whole.cycles) == (
        sum(r.fetched for r in table), sum(r.duplicates for r in table), sum(r.sent for r in table), sum(r.errors for r in table), len(table))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_merged_counts_and_a_batch_that_runs_again(spark, tmp_path, rows):
    def batch(*pairs):
        return spark.createDataFrame(pairs, "k string, n long")

    streams.merge_counts(batch(("a", 1), ("b", 2)), 0, f"{tmp_path}/c", ["k"])
    for _ in range(2):
        out = streams.merge_counts(batch(("b", 5), ("c", 1)), 3, f"{tmp_path}/c", ["k"])
        assert rows(out, "k", "n") == [("a", 1), ("b", 7), ("c", 1)]
    assert rows(streams.merge_counts(batch(("a", 1)), 4, f"{tmp_path}/c", ["k"]), "k", "n") == [("a", 2), ("b", 7), ("c", 1)]
