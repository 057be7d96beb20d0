"""Source, sink and stream queries.

Each one writes data derived from the test tables to a new folder under the session's
checkpoint folder and reads it back the way a job would.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import iso_text
from ..operators import clean, geo, index, report, reshape
from ..sources import readers, writers
from ..streaming import news as streams
from . import medallion, roles
from .queries_index import rounded
from .queries_news import PROPS, YEAR_RANGE_SQL, YEARS_SQL, wide_years, year_range, yearly_orders
from .queries_text import HTML_SQL
from .registry import query
from .roles import BOTH_SQL, NEWS_SQL

REGISTRY = "kecamatan string, nama_faskes string, tahun int"


@query("delimited_files", """
SELECT 'Nation_' || substr(n_name, 8) AS kecamatan, count(*) AS total_faskes, true AS has_file
FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")
def delimited_files(spark, sf_dir):
    """Supplier registry written as ';' files, read with lineage, cleaned and counted."""
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    registry = roles.table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        F.upper("n_name").alias("kecamatan"), F.col("s_name").alias("nama_faskes"), F.lit(2025).alias("tahun"))
    path = writers.scratch_dir(spark, "registry")
    registry.write.options(header=True, sep=";").csv(path)
    raw = readers.with_lineage(readers.read_delimited(spark, path, REGISTRY))
    rows = clean.clean_table(raw, ["kecamatan", "nama_faskes"], ["kecamatan"])
    return rows.groupBy("kecamatan").agg(
        F.count(F.lit(1)).alias("total_faskes"), F.bool_and(F.col("bronze_source_file").endswith(".csv")).alias("has_file"))


@query("period_files", f"""
WITH {YEARS_SQL.strip()} SELECT nation, CAST(year AS VARCHAR) AS period, 1 AS present FROM yearly""")
def period_files(spark, sf_dir):
    """One file per year, each landed twice, read together: copies of a year go, equal files of two years stay."""
    path = writers.scratch_dir(spark, "periods")
    yearly = yearly_orders(spark, sf_dir).select("nation", F.lit(1).alias("present"), F.col("year").alias("period"))
    for copy in ("first", "second"):
        # One sorted file per year: the rows of a year are one per nation, and most years have the same lines.
        yearly.repartition("period").sortWithinPartitions("nation").write.partitionBy("period").option("header", True).csv(f"{path}/{copy}")
    rows = readers.read_periods(spark, [f"{path}/first/*", f"{path}/second/*"], "nation int, present int",
                                period=lambda file: F.regexp_extract(file, r"period=(\d+)", 1))
    return rows.select("nation", "period", "present")


@query("feed_items", f"""
SELECT substr(sha256(url), 1, 16) AS id_berita, url AS link,
       'Page ' || page_id || CASE WHEN page_id % 3 = 0 THEN '' ELSE ' - site' || page_id % 7 END AS judul,
       '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || 'T10:20:30' AS tanggal_publikasi,
       CASE WHEN page_id % 3 = 0 THEN 'Stated' ELSE 'site' || page_id % 7 END AS sumber, 'Kriminalitas' AS kategori,
       {HTML_SQL.strip()} AS deskripsi_mentah
FROM pages WHERE NOT contains(url, 'utm_source')""")
def feed_items(spark, sf_dir):
    """Pages landed as RSS items; links with a feed mark become search pages and are left out."""
    path = write_feed(spark, sf_dir)
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return readers.feed_items(readers.read_feed(spark, path), "Kriminalitas", now).drop("ingested_at")


def write_feed(spark, sf_dir) -> str:
    def escaped(c):
        for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(char), F.lit(ref))
        return c

    number = F.col("page_id").cast("string")
    stated = F.col("page_id") % 3 == 0
    site = F.concat(F.lit("site"), (F.col("page_id") % 7).cast("string"))
    link = F.when(F.contains("url", F.lit("utm_source")), F.concat(F.lit("https://news.google.com/search?q="), number)).otherwise(F.col("url"))
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    item = F.concat(
        F.lit("<item><title>Page "), number, F.when(stated, "").otherwise(F.concat(F.lit(" - "), site)), F.lit("</title><link>"),
        escaped(link), F.lit("</link><pubDate>Mon, "), day, F.lit(" Jan 2024 10:20:30 GMT</pubDate>"),
        F.when(stated, '<source url="https://example.org">Stated</source>').otherwise(""),
        F.lit("<description>"), escaped(F.col("html")), F.lit("</description></item>"))
    # One feed file per 50 items: an opening line, the items, a closing line.
    feed = F.floor(F.col("page_id") / 50).alias("feed")
    items = roles.table(spark, sf_dir, "pages").select(feed, F.lit(1).alias("part"), item.alias("value"))
    frame = items.select("feed").distinct().select("feed", F.inline(F.array(
        F.struct(F.lit(0).alias("part"), F.lit("<rss><channel><title>Feed</title>").alias("value")),
        F.struct(F.lit(2).alias("part"), F.lit("</channel></rss>").alias("value")))))
    path = writers.scratch_dir(spark, "feed")
    (items.unionByName(frame).repartition("feed").sortWithinPartitions("feed", "part").drop("part")
     .write.partitionBy("feed").text(path))
    return path


@query("ingest_statistics", """
WITH got AS (SELECT * FROM pages WHERE page_id % 41 <> 0),
usable AS (SELECT substr(sha256(url), 1, 16) AS id FROM got WHERE NOT contains(url, 'utm_source')),
ids AS (SELECT id, count(*) AS n FROM usable GROUP BY ALL),
sent AS (SELECT count(*) AS sent FROM ids WHERE id NOT IN (SELECT substr(sha256(url), 1, 16) FROM pages WHERE starts_with(url, 'http://')))
SELECT (SELECT count(*) FROM got) AS fetched, (SELECT count(*) FROM usable) AS usable,
       (SELECT count(*) FROM usable) - sent AS duplicates, sent, (SELECT count(*) FROM pages WHERE page_id % 41 = 0) AS errors,
       (SELECT count(DISTINCT page_id // 100) FROM pages) AS cycles FROM sent""")
def ingest_statistics(spark, sf_dir):
    """Pages as the items of rounds of a hundred; some of the fetches failed."""
    pages = roles.table(spark, sf_dir, "pages")
    link = F.when(F.contains("url", F.lit("utm_source")), F.lit("https://news.google.com/search?q=1")).otherwise(F.col("url"))
    seen = pages.filter(F.startswith("url", F.lit("http://"))).select(F.substring(F.sha2("url", 256), 1, 16).alias("id_berita"))
    items = pages.select(link.alias("link"), F.when(F.col("page_id") % 41 == 0, "timeout").alias("error"),
                         F.floor(F.col("page_id") / 100).alias("cycle"))
    return readers.ingest_statistics(items, seen, "error", "cycle")


@query("html_rows", r"""
SELECT page_id, r - 1 AS row, array_to_string(list_transform(regexp_extract_all(ul, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1),
       lambda c: trim(regexp_replace(replace(regexp_replace(c, '<[^>]*>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g'))), '|') AS cells
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1)) AS ul,
             generate_subscripts(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1), 1) AS r FROM pages)""")
def html_rows(spark, sf_dir):
    """Lists of the pages as rows and cells, out of escaped HTML."""
    escaped = F.col("html")
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(ref))
    pages = roles.text_table(spark, sf_dir, "pages").select("page_id", escaped.alias("table"))
    rows = readers.html_table_rows(pages, "table", ["page_id"], row_tag="ul", cell_tags=("li",))
    return rows.select("page_id", F.col("row").cast("long").alias("row"), F.array_join("cells", "|").alias("cells"))


@query("envelope_rows", r"""
SELECT page_id AS table_id, r - 1 AS row, array_to_string(list_transform(regexp_extract_all(ul, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1),
       lambda c: trim(regexp_replace(replace(regexp_replace(c, '<[^>]*>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g'))), '|') AS cells
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1)) AS ul,
             generate_subscripts(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1), 1) AS r FROM pages)""")
def envelope_rows(spark, sf_dir):
    """The pages as escaped tables in JSON envelopes, fifty to a file, read back as rows and cells."""
    escaped = F.col("html")
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(ref))
    data = F.struct(F.col("page_id").alias("table_id"), F.col("url").alias("title"), escaped.alias("table"), F.lit("2024").alias("cr_date"))
    file = F.floor(F.col("page_id") / 50).alias("file")
    items = roles.table(spark, sf_dir, "pages").select(
        file, F.lit(1).alias("part"), F.concat(F.lit(","), F.to_json(F.struct(F.lit("OK").alias("status"), data.alias("data")))).alias("value"))
    frame = items.select("file").distinct().select("file", F.inline(F.array(
        F.struct(F.lit(0).alias("part"), F.lit('[{"status": "first"}').alias("value")),
        F.struct(F.lit(2).alias("part"), F.lit("]").alias("value")))))
    path = writers.scratch_dir(spark, "envelopes")
    (items.unionByName(frame).repartition("file").sortWithinPartitions("file", "part").drop("part")
     .write.partitionBy("file").text(path))
    envelopes = readers.read_envelope(spark, f"{path}/*/*.txt").filter("status = 'OK'")
    rows = readers.html_table_rows(envelopes, "table", ["table_id"], row_tag="ul", cell_tags=("li",))
    return rows.select("table_id", F.col("row").cast("long").alias("row"), F.array_join("cells", "|").alias("cells"))


@query("replaced_table", "SELECT s_suppkey, s_name, s_nationkey % 5 AS part FROM supplier")
def replaced_table(spark, sf_dir):
    """A table that is written, then replaced with other columns and partitions."""
    suppliers = roles.table(spark, sf_dir, "supplier")
    path = writers.scratch_dir(spark, "replaced")
    writers.overwrite(suppliers.select("s_suppkey", "s_acctbal"), path)
    writers.overwrite(suppliers.select("s_suppkey", "s_name", (F.col("s_nationkey") % 5).alias("part")), path, partition_by=["part"])
    return readers.read_table(spark, path)


@query("report_rows", f"""
WITH {YEARS_SQL.strip()}, {YEAR_RANGE_SQL.strip()}
SELECT 'sheet ' || n_regionkey AS report, CASE WHEN n_nationkey % 2 = 0 THEN 'regency' ELSE 'municipality' END AS section,
       n_name AS name, CAST(y AS VARCHAR) AS tahun, CAST(coalesce(n, 0) * 37 AS DOUBLE) AS jumlah
FROM nation CROSS JOIN years LEFT JOIN yearly ON nation = n_nationkey AND year = y
WHERE n_nationkey IN (SELECT nation FROM yearly) AND NOT (n_nationkey % 4 = 1 AND y % 2 = 0)""")
def report_rows(spark, sf_dir):
    """Sheets per region with two sections, thousands commas, empty cells, total and note, written and read as report files."""
    path = writers.scratch_dir(spark, "sheets")
    years = year_range(spark, sf_dir)
    cells = {f"c{i}": str(y) for i, y in enumerate(years, 2)}
    empty = F.col("nation") % 4 == 1
    wide = wide_years(spark, sf_dir, years).select("nation", *[
        F.when(~empty | F.lit(y % 2 == 1), F.format_number(F.col(str(y)) * 37, 0)).alias(c) for (c, y) in zip(cells, years)])
    nation = roles.table(spark, sf_dir, "nation")
    sheet = F.concat(F.lit("sheet "), F.col("n_regionkey").cast("string"))
    body = nation.join(wide, F.col("nation") == F.col("n_nationkey")).select(
        sheet.alias("sheet"), (F.col("n_nationkey") + F.when(F.col("n_nationkey") % 2 == 0, 100).otherwise(1000)).cast("long").alias("line"),
        F.col("n_name").alias("name"), F.lit(None).cast("string").alias("c1"), *cells)
    none, totals = [None] * len(cells), ["9,999"] * len(cells)
    fixed_lines = [(0, "Cases", none), (1, "Name", ["Total", *none[1:]]), (2, None, list(cells.values())),
                   (99, "Kabupaten/Regency", none), (999, "Kota/Municipality ", none), (5000, "All", totals), (5001, "Note: none\nSource: none", none)]
    frame = F.array(*[F.struct(F.lit(at).cast("long").alias("line"), *[F.lit(v).cast("string").alias(n) for n, v in zip(["name", "c1", *cells], [text, None, *rest])])
                      for at, text, rest in fixed_lines])
    around = nation.select(sheet.alias("sheet")).distinct().select("sheet", F.inline(frame))
    # One small file per sheet, its lines in order.
    (body.unionByName(around).repartition("sheet").sortWithinPartitions("sheet", "line").drop("line")
     .write.partitionBy("sheet").option("quote", '"').csv(path))
    raw = readers.read_report(spark, f"{path}/*/*.csv", 2 + len(cells))
    named = raw.withColumn("report", F.replace(F.regexp_extract("report", r"sheet=([^/]+)/", 1), F.lit("%20"), F.lit(" ")))
    rows = reshape.report_rows(named, "report", "line", "c0", cells,
                               {"Kabupaten/Regency": "regency", "Kota/Municipality": "municipality"}, ["All"])
    return rows.withColumnRenamed("c0", "name")


@query("messages", """
SELECT CAST(event_id AS VARCHAR) AS kafka_key, 'news' AS kafka_topic, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events""")
def messages(spark, sf_dir):
    """Events published as keyed JSON messages and read back from the topic's files."""
    events = roles.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id_berita"), "event_type", "props")
    path = writers.scratch_dir(spark, "messages")
    writers.publish_messages(events, "news", fmt="parquet", path=path)
    read = readers.read_table(spark, path).select(F.col("key").cast("string").alias("kafka_key"), "topic", F.col("value").cast("string").alias("v"))
    parsed = read.withColumn("d", F.from_json("v", "event_type string, props string"))
    return parsed.select("kafka_key", F.col("topic").alias("kafka_topic"), F.from_json("d.props", PROPS).k.alias("k"), "d.event_type")


# --- gold table and its exports ------------------------------------------------------------

def gold_table(spark, sf_dir):
    """Both indices written once with a checked schema; the exports read them from there."""
    path = writers.scratch_dir(spark, "gold")
    writers.overwrite_checked(roles.risk(spark, sf_dir), path)
    return readers.read_table(spark, path)


@query("document", f"""
WITH {BOTH_SQL}, {NEWS_SQL.strip()}
SELECT * FROM (SELECT 'kriminalitas' AS section, row_number() OVER (ORDER BY indeks_kriminalitas DESC, kecamatan) - 1 AS position,
       kecamatan AS name, round(indeks_kriminalitas, 6) AS value FROM crime) WHERE position < 20
UNION ALL SELECT * FROM (SELECT 'kesehatan', row_number() OVER (ORDER BY indeks_kesehatan DESC, kecamatan) - 1 AS position, kecamatan, round(indeks_kesehatan, 6) FROM health)
  WHERE position < 20
UNION ALL SELECT * FROM (SELECT 'berita' AS section, row_number() OVER (ORDER BY tanggal_publikasi DESC, id_berita) - 1 AS position, id_berita AS name,
       NULL::DOUBLE AS value FROM news_rows WHERE kecamatan_terdeteksi <> 'unknown' ORDER BY position LIMIT 50)""")
def document(spark, sf_dir):
    """The published document (top 20 districts, latest 50 news), written as JSON and read back as its three relations."""
    return document_relations(spark, sf_dir, 20)


@query("document_whole", f"""
WITH {BOTH_SQL}, {NEWS_SQL.strip()}
SELECT 'kriminalitas' AS section, row_number() OVER (ORDER BY indeks_kriminalitas DESC NULLS LAST, kecamatan) - 1 AS position,
       kecamatan AS name, round(indeks_kriminalitas, 6) AS value FROM crime
UNION ALL SELECT 'kesehatan', row_number() OVER (ORDER BY indeks_kesehatan DESC NULLS LAST, kecamatan) - 1, kecamatan, round(indeks_kesehatan, 6) FROM health
UNION ALL SELECT * FROM (SELECT 'berita' AS section, row_number() OVER (ORDER BY tanggal_publikasi DESC, id_berita) - 1 AS position, id_berita AS name,
       NULL::DOUBLE AS value FROM news_rows WHERE kecamatan_terdeteksi <> 'unknown' ORDER BY position LIMIT 50)""")
def document_whole(spark, sf_dir):
    """The published document with every district, as *document* has its first ones."""
    return document_relations(spark, sf_dir, None)


def document_relations(spark, sf_dir, districts):
    gold = gold_table(spark, sf_dir)
    path, news = writers.scratch_dir(spark, "document"), roles.event_news(spark, sf_dir)
    if districts is None:
        writers.write_document_lines(writers.document_lines(writers.publish_rows(gold, gold, news, 50), "2024-01-31T00:00:00"), path)
    else:
        writers.write_document(writers.publish(gold, gold, news, 50, districts, "2024-01-31T00:00:00"), path)
    parts = readers.read_document(spark, path)
    columns = {"kriminalitas": ("kecamatan", "indeks_kriminalitas"), "kesehatan": ("kecamatan", "indeks_kesehatan"), "berita": ("id_berita", None)}
    return rounded(reshape.union_all([
        parts[s].select(F.lit(s).alias("section"), F.col("position").cast("long").alias("position"), F.col(k).alias("name"),
                        (F.col(v) if v else F.lit(None).cast("double")).alias("value")) for s, (k, v) in columns.items()]))


@query("export_rows", f"""
WITH {BOTH_SQL}, {NEWS_SQL.strip()}
SELECT 'kriminalitas' AS section, row_number() OVER (ORDER BY indeks_kriminalitas DESC NULLS LAST, kecamatan) - 1 AS position,
       kecamatan AS key, CAST(total_kasus_kriminal AS VARCHAR) AS cases FROM crime
UNION ALL SELECT 'kesehatan', row_number() OVER (ORDER BY indeks_kesehatan DESC NULLS LAST, kecamatan) - 1, kecamatan, CAST(total_kasus_wabah AS VARCHAR) FROM health
UNION ALL SELECT * FROM (SELECT 'berita', row_number() OVER (ORDER BY tanggal_publikasi DESC, id_berita) - 1 AS position, id_berita, kategori
  FROM news_rows WHERE kecamatan_terdeteksi <> 'unknown' ORDER BY position LIMIT 100)""")
def export_rows(spark, sf_dir):
    """Every district and the latest 100 news as rows with their place in the display order."""
    gold = gold_table(spark, sf_dir)
    rows = writers.publish_rows(gold, gold, roles.event_news(spark, sf_dir), 100)
    fields = [F.get_json_object("payload", f"$.{c}") for c in ("total_kasus_kriminal", "total_kasus_wabah", "kategori")]
    return rows.select("section", "position", "key", F.coalesce(*fields).alias("cases"))


@query("csv_export", f"""
WITH {BOTH_SQL}
SELECT '"' || kecamatan || '","' || total_kasus_kriminal || '","' || printf('%.2f', crime_rate) || '","' || printf('%.2f', indeks_kriminalitas) || '"' AS line,
       false AS head FROM crime
UNION ALL SELECT chr(65279) || '"Kecamatan","Total Kasus","Crime Rate","Indeks Kriminalitas"', true""")
def csv_export(spark, sf_dir):
    """The lines of the export; the header with its byte order mark is the first line of each file, and of no other place."""
    path = writers.scratch_dir(spark, "csv")
    writers.write_csv(roles.crime(spark, sf_dir), path, {
        "kecamatan": "Kecamatan", "total_kasus_kriminal": "Total Kasus", "crime_rate": "Crime Rate",
        "indeks_kriminalitas": "Indeks Kriminalitas"}, decimals=("crime_rate", "indeks_kriminalitas"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    # The files are small and not split, so the first line of a file has its least number.
    first = lines.groupBy("file").agg(F.min("at").alias("at")).withColumn("head", F.lit(True))
    # The text reader takes the mark away, so it is looked up in the bytes.
    mark = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select(
        F.col("path").alias("file"), F.when(F.substring("content", 1, 3) == F.lit(b"\xef\xbb\xbf"), "\ufeff").otherwise("").alias("mark"))
    marked = lines.join(first, ["file", "at"], "left").join(mark.withColumn("head", F.lit(True)), ["file", "head"], "left").select(
        F.concat(F.coalesce("mark", F.lit("")), "value").alias("line"), F.coalesce("head", F.lit(False)).alias("head"))
    return marked.filter("head").distinct().unionByName(marked.filter("NOT head"))


@query("verify_layer", """
SELECT 'lineitem' AS table_name, true AS present, count(*) AS rows, 11 AS columns FROM lineitem
UNION ALL SELECT 'events', true, count(*), 6 FROM events UNION ALL SELECT 'documents', true, count(*), 5 FROM documents
UNION ALL SELECT 'absent', false, NULL, NULL""")
def verify_layer(spark, sf_dir):
    return medallion.verify_layer(spark, {n: f"{sf_dir}/{n}.parquet" for n in ("lineitem", "events", "documents", "absent")})


@query("facility_snapshot", """
SELECT n_name AS kecamatan, count(DISTINCT s_suppkey) FILTER (s_suppkey % 3 <> 1) AS one_period, count(*) * 2 AS every_row
FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL HAVING count(*) FILTER (s_suppkey % 3 <> 1) > 0""")
def facility_snapshot(spark, sf_dir):
    """Each facility is in two periods or twice in one: all rows against one period, counted once."""
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("kecamatan"))
    suppliers = roles.table(spark, sf_dir, "supplier").join(nation, "s_nationkey")
    periods = (F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("2024"), F.lit("2025")))
               .when(F.col("s_suppkey") % 3 == 1, F.array(F.lit("2024"), F.lit("2024"))).otherwise(F.array(F.lit("2025"), F.lit("2025"))))
    rows = suppliers.select("kecamatan", "s_suppkey", F.explode(periods).alias("periode"))
    one = index.count_per_key(index.snapshot(rows, "2025", distinct_by=["s_suppkey"]), "kecamatan", "one_period")
    return index.count_per_key(rows, "kecamatan", "every_row").join(one, "kecamatan")


# --- streams -------------------------------------------------------------------------------

GAZETTEER = ["purchase order", "error", "purchase", "signup"]


def event_files(spark, sf_dir):
    """The event table as a stream of files (a file stream reads a folder)."""
    schema = StructType.fromDDL(roles.SCHEMAS["events"])
    return streams.open_stream(spark, "parquet", sf_dir, schema, pathGlobFilter="events.parquet")


def event_stream(spark, sf_dir):
    """The events as a stream of message rows with the columns of a Kafka source."""
    events = event_files(spark, sf_dir)
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    payload = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id_berita"), F.concat(F.lit("News: "), F.initcap("event_type"), F.lit("!")).alias("judul"),
        F.concat(F.lit("https://example.org/"), F.col("event_id").cast("string")).alias("link"), stamp.alias("tanggal_publikasi"),
        F.lit("feed").alias("sumber"), F.col("event_type").alias("kategori"), F.col("props").alias("deskripsi_mentah")))
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"), payload.cast("binary").alias("value"), F.lit("news").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))


@query("stream_silver", """
SELECT CAST(event_id AS VARCHAR) AS id_berita, event_type AS kategori, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published,
       CASE WHEN event_type IN ('error', 'purchase', 'signup') THEN upper(event_type[1]) || event_type[2:] ELSE 'unknown' END AS kecamatan_terdeteksi
FROM events""")
def stream_silver(spark, sf_dir):
    """Messages to raw table to clean table, both as streams that stop when drained."""
    layout = medallion.Layout(writers.scratch_dir(spark, "stream"))
    medallion.ingest_news(event_stream(spark, sf_dir), layout)
    medallion.clean_news_stream(spark, layout, gazetteer=GAZETTEER)
    news = readers.read_or_empty(spark, layout.silver("tbl_clean_news"), clean.NEWS_SCHEMA)
    return news.select("id_berita", "kategori", iso_text("tanggal_publikasi").alias("published"), "kecamatan_terdeteksi")


@query("partitioned_news", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS kafka_date, upper(event_type[1]) || event_type[2:] AS place, count(*) AS n FROM events
WHERE event_type = 'purchase' GROUP BY ALL""")
def partitioned_news(spark, sf_dir):
    """Raw news by message date and clean news by place; each is read by its partitions."""
    layout = medallion.Layout(writers.scratch_dir(spark, "parts"))
    medallion.ingest_news(event_stream(spark, sf_dir), layout, by_date=True)
    medallion.clean_news_stream(spark, layout, gazetteer=GAZETTEER, by_place=True)
    raw = readers.read_table(spark, layout.bronze("tbl_raw_news")).select(
        F.col("kafka_key").alias("id_berita"), F.col("kafka_date").cast("string").alias("kafka_date"))
    clean_rows = readers.read_table(spark, layout.silver("tbl_clean_news")).filter("kecamatan_terdeteksi = 'Purchase'")
    return (clean_rows.join(raw, "id_berita").groupBy("kafka_date", F.col("kecamatan_terdeteksi").alias("place"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("stream_dedup", """
SELECT DISTINCT event_type, user_id, NULL::BIGINT AS event_id FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, user_id, event_id FROM events WHERE event_type = 'error'""")
def stream_dedup(spark, sf_dir):
    """Two streams over the events, the latest days first: late first-time keys stay, and all rows without a key."""
    path = writers.scratch_dir(spark, "dedup")
    key = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    for part, days in (("late", F.col("ts") >= middle), ("early", F.col("ts") < middle)):
        rows = event_files(spark, sf_dir).filter(days).select(key, "user_id", "event_id")
        streams.dedup_stream(rows, ["event_type", "user_id"], f"{path}/out", f"{path}/seen", f"{path}/checkpoint-{part}",
                             ["event_id"]).awaitTermination()
    kept = readers.read_table(spark, f"{path}/out")
    return kept.select("event_type", "user_id", F.when(F.col("event_type").isNull(), F.col("event_id")).alias("event_id"))


@query("stream_refresh", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def stream_refresh(spark, sf_dir):
    """A product that is rebuilt from the new keys of each batch."""
    events = event_files(spark, sf_dir)
    path = writers.scratch_dir(spark, "refresh")

    def refresh(fresh, batch_id):
        fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("users")).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    # A second stream over the same keys and the same table of seen keys finds nothing new.
    for checkpoint in ("first", "second"):
        streams.refresh_on_new(events.select("event_type", "user_id"), f"{path}/seen", f"{path}/checkpoint-{checkpoint}",
                               ["event_type", "user_id"], refresh).awaitTermination()
    return readers.read_table(spark, f"{path}/out").groupBy("event_type").agg(F.sum("users").alias("users"))


@query("enrich_place", """
SELECT s_suppkey, s_nationkey % 5 * 1.5::DOUBLE AS area_km2 FROM supplier""")
def enrich_place(spark, sf_dir):
    nation = roles.table(spark, sf_dir, "nation")
    dimension = nation.select(F.lower("n_name").alias("place_key"), (F.col("n_nationkey") % 5 * F.lit(1.5)).alias("area_km2"))
    names = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.concat(F.lit("Kec. "), "n_name").alias("place"))
    suppliers = roles.table(spark, sf_dir, "supplier").join(names, "s_nationkey")
    return geo.enrich_place(suppliers, dimension, "place").select("s_suppkey", "area_km2")


@query("stream_resume", "SELECT event_id, event_type, 1::BIGINT AS times FROM events")
def stream_resume(spark, sf_dir):
    """A drain in small batches that fails in one of them and goes on from its checkpoint: each row once."""
    path = writers.scratch_dir(spark, "resume")
    events = roles.table(spark, sf_dir, "events").select("event_id", "event_type")
    events.repartitionByRange(6, "event_id").write.parquet(f"{path}/in")
    middle = events.agg(F.avg("event_id")).first()[0] or 0.0
    rows = streams.open_stream(spark, "parquet", f"{path}/in", events.schema, maxFilesPerTrigger=1)
    stopped = F.when(F.col("event_id") > middle, F.raise_error(F.lit("stopped on purpose")).cast("long")).otherwise(F.col("event_id"))
    try:
        streams.drain(rows.withColumn("event_id", stopped), f"{path}/out", f"{path}/checkpoint")
    except StreamingQueryException as error:
        if "stopped on purpose" not in str(error):
            raise
    streams.drain(rows, f"{path}/out", f"{path}/checkpoint")
    written = readers.read_table(spark, f"{path}/out")
    return written.groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("times"))


@query("stream_statistics", """
WITH got AS (SELECT page_id // 100 % 2 AS batch, url FROM pages WHERE page_id % 41 <> 0),
firsts AS (SELECT url, min(batch) AS batch FROM got GROUP BY url)
SELECT b.batch::BIGINT AS batch, (SELECT count(*) FROM got WHERE got.batch = b.batch) AS fetched,
       (SELECT count(*) FROM firsts WHERE firsts.batch = b.batch) AS sent,
       (SELECT count(*) FROM got WHERE got.batch = b.batch) - (SELECT count(*) FROM firsts WHERE firsts.batch = b.batch) AS duplicates,
       (SELECT count(*) FROM pages WHERE page_id % 41 = 0 AND page_id // 100 % 2 = b.batch) AS errors
FROM (SELECT DISTINCT page_id // 100 % 2 AS batch FROM pages) b""")
def stream_statistics(spark, sf_dir):
    """The statistics of a running stream of two cycles, told by its own progress."""
    path = writers.scratch_dir(spark, "statistics")
    pages = roles.table(spark, sf_dir, "pages").select("url", F.when(F.col("page_id") % 41 == 0, "timeout").alias("error"),
                                                       (F.floor(F.col("page_id") / 100) % 2).cast("int").alias("cycle"))
    listener = streams.IngestStatistics()
    spark.streams.addListener(listener)
    try:
        for cycle in (0, 1):
            pages.filter(F.col("cycle") == cycle).drop("cycle").write.mode("append").parquet(f"{path}/in")
            rows = streams.open_stream(spark, "parquet", f"{path}/in", pages.drop("cycle").schema)
            query = streams.dedup_stream(rows, ["url"], f"{path}/out", None, f"{path}/checkpoint", error="error")
            query.awaitTermination()
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    return listener.table(spark).select("batch", "fetched", "sent", "duplicates", "errors")


@query("stream_gold", f"""
WITH {roles.PEOPLE_SQL.strip()},
firsts AS (SELECT DISTINCT event_type, user_id FROM events),
fresh AS (SELECT user_id % 25 AS nk, count(*) AS n FROM firsts GROUP BY ALL),
crime0 AS (SELECT kecamatan, coalesce(returned, 0) + coalesce(n, 0) AS total_kasus_kriminal,
                  CAST(coalesce(returned, 0) + coalesce(n, 0) AS DOUBLE) / nullif(jumlah_penduduk, 0) * 100000 AS rate
           FROM base LEFT JOIN lines USING (nk) LEFT JOIN fresh USING (nk))
SELECT kecamatan, total_kasus_kriminal, round((rate - min(rate) OVER ()) / CASE WHEN max(rate) OVER () > min(rate) OVER ()
       THEN max(rate) OVER () - min(rate) OVER () ELSE 1.0 END * 100, 6) AS indeks_kriminalitas FROM crime0""")
def stream_gold(spark, sf_dir):
    """The crime index kept up by a stream: new items of three batches are added to stored counts, and the index made from those."""
    path = writers.scratch_dir(spark, "upkeep")
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("kecamatan"))
    events = roles.table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    events.repartitionByRange(3, "event_id").write.parquet(f"{path}/in")
    rows = streams.open_stream(spark, "parquet", f"{path}/in", events.schema, maxFilesPerTrigger=1)

    def add(fresh, batch_id):
        counts = (fresh.groupBy((F.col("user_id") % 25).alias("place")).agg(F.count(F.lit(1)).alias("total_kasus_berita_kriminal"))
                  .join(nation, "place").select("kecamatan", "total_kasus_berita_kriminal"))
        streams.merge_counts(counts, batch_id, f"{path}/counts", ["kecamatan"])

    streams.refresh_on_new(rows, None, f"{path}/checkpoint", ["event_type", "user_id"], add).awaitTermination()
    versions = readers.read_table(spark, f"{path}/counts")
    counts = versions.filter(F.col("version") == versions.agg(F.max("version")).scalar()).select("kecamatan", "total_kasus_berita_kriminal")
    crime = index.crime_index(roles.districts(spark, sf_dir, returned=True), counts)
    return rounded(crime.select("kecamatan", "total_kasus_kriminal", "indeks_kriminalitas"))


@query("distinct_by_sketch", """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS first FROM events)
SELECT strftime(first, '%Y-%m-%d') AS first, (SELECT count(DISTINCT user_id) FROM events WHERE CAST(ts AS DATE) BETWEEN first AND first + 6) AS exact, true AS within
FROM days""")
def distinct_by_sketch(spark, sf_dir):
    """Users of the week from each day on: by the union of stored daily sketches, held against the exact count."""
    events = roles.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    path = writers.scratch_dir(spark, "sketches")
    writers.overwrite(report.daily_sketches(events, "user_id", "day"), path)
    ranges = events.select(F.col("day").alias("first")).distinct().withColumn("last", F.date_add("first", 6))
    near = report.distinct_between(readers.read_table(spark, path), ranges)
    met = events.distinct().join(ranges, F.col("day").between(F.col("first"), F.col("last")))
    exact = met.groupBy("first").agg(F.count_distinct("user_id").alias("exact"))
    within = F.abs(F.col("distinct_values") - F.col("exact")) <= F.ceil(F.col("exact") * report.sketch_error())
    return near.join(exact, "first").select(F.col("first").cast("string").alias("first"), "exact", within.alias("within"))
