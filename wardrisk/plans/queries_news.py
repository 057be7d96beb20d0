"""News queries: parsing, filters, de-duplication, maps, series and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_text, normalize_key
from ..operators import clean, geo, index, quality, rank, report, reshape
from . import roles
from .queries_index import rounded
from .registry import query
from .roles import AS_OF, NEWS_SQL

PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@query("json_flatten", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_flatten(spark, sf_dir):
    return clean.parse_json(roles.table(spark, sf_dir, "events"), PROPS, "props", keep=["event_id"])


def payload_messages(spark, sf_dir):
    """Events as raw news messages; some payloads are cut off, some dates are not ISO."""
    kind = F.col("event_id") % 10
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    payload = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id_berita"),
        F.concat(F.lit("Title "), "event_type").alias("judul"),
        F.concat(F.lit("https://example.org/"), F.col("event_id").cast("string")).alias("link"),
        F.when(kind == 3, F.lit("Mon, 01 Jan 2024 10:00:00 GMT")).otherwise(stamp).alias("tanggal_publikasi"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("sumber"),
        F.col("event_type").alias("kategori"), F.col("props").alias("deskripsi_mentah"),
        stamp.alias("ingested_at")))
    raw = F.when(kind == 7, F.substring(payload, 1, 20)).otherwise(payload)
    return roles.table(spark, sf_dir, "events").select(
        "event_id", raw.alias("raw_value"), F.col("ts").cast("timestamp").alias("kafka_timestamp"))


@query("parse_messages", """
SELECT event_id, CASE WHEN event_id % 10 <> 7 THEN CAST(event_id AS VARCHAR) END AS id_berita,
       CASE WHEN event_id % 10 <> 7 THEN event_type END AS kategori,
       CASE WHEN event_id % 10 NOT IN (3, 7) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS published
FROM events""")
def parse_messages(spark, sf_dir):
    news = clean.parse_news(payload_messages(spark, sf_dir), keep=["event_id"])
    return news.select("event_id", "id_berita", "kategori", iso_text("tanggal_publikasi").alias("published"))


@query("safe_casts", """
SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS size,
       CAST(TRY_CAST(CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE) AS DOUBLE) AS price
FROM part""")
def safe_casts(spark, sf_dir):
    text = roles.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 == 0, "n/a").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_partkey") % 11 == 0, "").otherwise(F.col("p_retailprice").cast("string")).alias("price"))
    return clean.clean_table(text, casts={"size": "int", "price": "double"}, dedup=False)


@query("clean_table", """
SELECT * FROM (SELECT DISTINCT CASE WHEN s_suppkey % 9 <> 0 THEN 'Nation_' || substr(n_name, 8) END AS kecamatan,
       CASE WHEN s_suppkey % 9 <> 0 THEN s_name END AS nama_faskes, CAST(floor(s_acctbal) AS INTEGER) AS jumlah
FROM supplier JOIN nation ON n_nationkey = s_nationkey) WHERE kecamatan IS NOT NULL""")
def clean_rows(spark, sf_dir):
    """Supplier registry with every row twice, missing names, odd spelling and text numbers."""
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    present = F.col("s_suppkey") % 9 != 0
    raw = roles.table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        F.when(present, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).alias("kecamatan"),
        F.when(present, F.col("s_name")).alias("nama_faskes"),
        F.floor("s_acctbal").cast("string").alias("jumlah"))
    return clean.clean_table(raw.unionAll(raw), ["kecamatan", "nama_faskes"], ["kecamatan"], {"jumlah": "int"})


@query("dedup_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def dedup_rows(spark, sf_dir):
    return clean.clean_table(roles.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@query("dedup_news", """
WITH items AS (SELECT CASE WHEN event_id % 10 <> 7 THEN user_id END AS id_berita, date_trunc('day', ts) AS day, event_id FROM events)
SELECT id_berita, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY id_berita ORDER BY day, event_id) AS r FROM items) WHERE r = 1 OR id_berita IS NULL""")
def dedup_news(spark, sf_dir):
    """The first item per id; broken items have no id and all stay, equal times go by the other columns."""
    events = roles.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 7, F.col("user_id")).alias("id_berita"), "event_id",
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("kafka_timestamp"))
    return clean.dedup_news(events).select("id_berita", "event_id")


@query("dedup_text", """
SELECT min(doc_id) AS doc_id, count(*) AS copies, substr(sha256(text), 1, 16) AS id FROM documents GROUP BY sha256(text)""")
def dedup_text(spark, sf_dir):
    """One id per distinct text; only hashes and ids travel, not the texts."""
    hashed = roles.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return hashed.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).select(
        "doc_id", "copies", F.substring("h", 1, 16).alias("id"))


@query("news_identity", """
SELECT CASE WHEN event_id % 3 > 0 THEN 'https://example.org/' || user_id ELSE 'Title ' || event_type END AS identity, count(*) AS n
FROM events GROUP BY ALL""")
def news_identity(spark, sf_dir):
    """Items by what a reader counts as the same: the link, else the title; links may be empty or missing."""
    link = (F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("https://example.org/"), F.col("user_id").cast("string")))
            .when(F.col("event_id") % 2 == 0, ""))
    items = roles.table(spark, sf_dir, "events").select(link.alias("link"), F.concat(F.lit("Title "), "event_type").alias("judul"))
    return items.groupBy(clean.news_identity().alias("identity")).agg(F.count(F.lit(1)).alias("n"))


@query("new_items", """
SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
  AND (o_custkey, o_orderpriority) NOT IN (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""")
def new_items(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    border = F.lit("1999-01-01").cast("timestamp_ntz")
    incoming = orders.filter(F.col("o_orderdate") >= border).drop("o_orderdate")
    return clean.new_items(incoming, orders.filter(F.col("o_orderdate") < border), ["o_custkey", "o_orderpriority"])


@query("news_filter", f"""
WITH {NEWS_SQL.strip()}
SELECT event_id FROM news_rows WHERE kategori = 'error' AND kecamatan_terdeteksi = 'NATION_4'
  AND tanggal_publikasi >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY AND contains(lower(judul), 'event error 8')""")
def news_filter(spark, sf_dir):
    return clean.news_filter(roles.event_news(spark, sf_dir), search=" Event ERROR 8", category="error",
                             place="Kecamatan nation_4", days=14, as_of=AS_OF).select("event_id")


@query("recent_news", f"""
WITH {NEWS_SQL.strip()}
SELECT id_berita, judul, link, strftime(tanggal_publikasi, '%Y-%m-%dT%H:%M:%S') AS tanggal_publikasi, sumber, kategori,
       kecamatan_terdeteksi, deskripsi_mentah
FROM news_rows WHERE kecamatan_terdeteksi <> 'unknown' ORDER BY news_rows.tanggal_publikasi DESC, id_berita LIMIT 50""")
def recent_news(spark, sf_dir):
    from ..sources.writers import NEWS_FIELDS
    from ..sources.writers import recent_news as latest

    return latest(roles.event_news(spark, sf_dir), 50).withColumn("tanggal_publikasi", iso_text("tanggal_publikasi")).select(*NEWS_FIELDS)


@query("latest_per_key", f"""
WITH {NEWS_SQL.strip()}
SELECT kecamatan_terdeteksi, event_id, p AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY kecamatan_terdeteksi ORDER BY tanggal_publikasi DESC, id_berita) AS p FROM news_rows)
WHERE p <= 3""")
def latest_per_key(spark, sf_dir):
    news = roles.event_news(spark, sf_dir)
    return rank.latest_per_key(news, "kecamatan_terdeteksi", "tanggal_publikasi", 3, "id_berita").select(
        "kecamatan_terdeteksi", "event_id", "position")


@query("news_summary", f"""
WITH {NEWS_SQL.strip()}
SELECT count(*) AS total, count(*) FILTER (kategori = 'error') AS crime_news,
       count(*) FILTER (kategori <> 'error') AS other_news, count(DISTINCT kecamatan_terdeteksi) AS places,
       strftime(max(tanggal_publikasi), '%Y-%m-%dT%H:%M:%S') AS latest FROM news_rows""")
def news_summary(spark, sf_dir):
    news = roles.event_news(spark, sf_dir)
    summary = report.news_summary(news, "kategori", "kecamatan_terdeteksi", "tanggal_publikasi", "error")
    return summary.withColumn("latest", iso_text("latest"))


@query("distinct_places", f"""
WITH {NEWS_SQL.strip()} SELECT DISTINCT kecamatan_terdeteksi FROM news_rows ORDER BY 1""")
def distinct_places(spark, sf_dir):
    return reshape.distinct_values(roles.event_news(spark, sf_dir), "kecamatan_terdeteksi")


@query("label_counts", f"""
WITH {NEWS_SQL.strip()}
SELECT kecamatan_terdeteksi AS kecamatan, count(*) FILTER (kategori = 'error') AS total_kasus_berita_kriminal,
       count(*) FILTER (kategori = 'signup') AS total_kasus_berita_wabah FROM news_rows GROUP BY ALL""")
def label_counts(spark, sf_dir):
    news = roles.event_news(spark, sf_dir).withColumn("label", roles.label_of("kategori"))
    return index.news_counts(news, "kecamatan_terdeteksi", "label")


@query("choropleth", f"""
WITH {NEWS_SQL.strip()},
recent AS (SELECT * FROM news_rows WHERE tanggal_publikasi >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY),
counted AS (SELECT kecamatan_terdeteksi AS n_name, count(*) FILTER (kategori = 'error') AS bad,
            count(*) FILTER (kategori = 'signup') AS good FROM recent GROUP BY ALL)
SELECT n_name, coalesce(bad, 0) AS bad_count, coalesce(good, 0) AS good_count, coalesce(bad + good, 0) AS total_count,
       round(bad::DOUBLE / nullif(bad + good, 0) * 100, 6) AS news_score,
       CASE WHEN bad + good = 0 OR bad IS NULL THEN NULL WHEN bad::DOUBLE / (bad + good) * 100 >= 80 THEN '4'
            WHEN bad::DOUBLE / (bad + good) * 100 >= 60 THEN '3' WHEN bad::DOUBLE / (bad + good) * 100 >= 40 THEN '2'
            WHEN bad::DOUBLE / (bad + good) * 100 >= 20 THEN '1' ELSE '0' END AS news_step
FROM nation LEFT JOIN counted USING (n_name)""")
def choropleth(spark, sf_dir):
    news = clean.news_filter(roles.event_news(spark, sf_dir), days=10, as_of=AS_OF)
    places = roles.table(spark, sf_dir, "nation").select("n_name")
    return rounded(geo.choropleth(places, news, "n_name", "kecamatan_terdeteksi", "kategori", "error", "signup").drop("place_key"))


# --- map points ------------------------------------------------------------------------

CENTRES = {f"nation_{i}": (112.60 + 0.01 * i, -7.20 - 0.01 * (i % 10)) for i in range(0, 24)}
CENTRES_SQL = "centres(kecamatan_terdeteksi, lon, lat) AS (VALUES " + ", ".join(
    f"('{k.upper()}', {lon!r}::DOUBLE, {lat!r}::DOUBLE)" for k, (lon, lat) in CENTRES.items()) + ")"

POINTS_SQL = f"""{NEWS_SQL.strip()}, {CENTRES_SQL},
numbered AS (
  SELECT event_id, id_berita, kecamatan_terdeteksi, kategori, judul,
         row_number() OVER (ORDER BY tanggal_publikasi DESC, id_berita) - 1 AS i FROM news_rows),
waves AS (SELECT *, sin(i + 1) * 10000 AS s, cos(i + 1) * 10000 AS c FROM numbered),
points AS (
  SELECT w.*, coalesce(lon, 112.7521) + (c - floor(c) - 0.5) * 0.012 AS point_lon,
         coalesce(lat, -7.2575) + (s - floor(s) - 0.5) * 0.012 AS point_lat
  FROM waves w LEFT JOIN centres USING (kecamatan_terdeteksi))"""


def news_points(spark, sf_dir):
    rows = [(key, lon, lat) for key, (lon, lat) in CENTRES.items()]
    centres = geo.literal_dimension(spark, rows, ["place_key", "lon", "lat"])
    # The numbered rows are written out, so only the columns in use go along.
    news = roles.event_news(spark, sf_dir).select(
        "event_id", "id_berita", "tanggal_publikasi", "kecamatan_terdeteksi", "judul", "kategori")
    news = geo.recency_index(news, "tanggal_publikasi", "id_berita")
    placed = geo.enrich_place(news, centres, "kecamatan_terdeteksi", {})
    return geo.jitter(placed, "index")


@query("jitter_points", f"""
WITH {POINTS_SQL}
SELECT event_id, i AS index, round(point_lon, 6) AS point_lon, round(point_lat, 6) AS point_lat FROM points""")
def jitter_points(spark, sf_dir):
    return rounded(news_points(spark, sf_dir).select("event_id", "index", "point_lon", "point_lat"))


@query("geocoded_points", f"""
WITH {POINTS_SQL},
chosen AS (SELECT event_id, point_lon, point_lat, kategori = 'purchase' AS cached, 112.5 + (event_id % 50) * 0.01 AS glon,
           -7.5 + (event_id % 40) * 0.01 AS glat FROM points),
boxed AS (SELECT *, cached AND glat BETWEEN -7.45 AND -7.15 AND glon BETWEEN 112.55 AND 112.90 AS used FROM chosen)
SELECT event_id, used AS from_cache, round(CASE WHEN used THEN glon ELSE point_lon END, 6) AS point_lon,
       round(CASE WHEN used THEN glat ELSE point_lat END, 6) AS point_lat FROM boxed""")
def geocoded_points(spark, sf_dir):
    """Purchases have a geocoded point, some of them outside the box."""
    cache = roles.table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        "event_id", F.expr("112.5D + (event_id % 50) * 0.01D").alias("geo_lon"),
        F.expr("-7.5D + (event_id % 40) * 0.01D").alias("geo_lat"))
    points = news_points(spark, sf_dir).select("event_id", "point_lon", "point_lat")
    return rounded(geo.choose_point(points, cache, "event_id"))


@query("point_features", f"""
WITH {POINTS_SQL}
SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || CAST(round(point_lon * 1000) AS BIGINT) || ',' ||
       CAST(round(point_lat * 1000) AS BIGINT) || ']}},"properties":{{"id":' || i || ',"title":"' || judul || '","category":"' || kategori || '"}}}}' AS feature
FROM points""")
def point_features(spark, sf_dir):
    milli = news_points(spark, sf_dir).select(
        "index", "judul", "kategori", F.round(F.col("point_lon") * 1000).cast("long").alias("x"),
        F.round(F.col("point_lat") * 1000).cast("long").alias("y"))
    return geo.point_features(milli, "x", "y", [
        F.col("index").alias("id"), F.col("judul").alias("title"), F.col("kategori").alias("category")])


# --- boundaries --------------------------------------------------------------------------

def event_ways(spark, sf_dir):
    """One closed boundary per event: three to nine ways on a circle, some turned round.

    The ways come in mixed order; each holds its two ends and a point between them.
    """
    events = roles.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("relation_id"), (3 + F.col("event_id") % 7).alias("n"), (1 + F.col("user_id") % 5).alias("r"))
    parts = events.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))

    def point(i):
        angle = i * 2 * F.pi() / F.col("n")
        return F.struct((F.col("r") * F.cos(angle)).alias("x"), (F.col("r") * F.sin(angle)).alias("y"))

    start, end = point(F.col("i")), point((F.col("i") + 1) % F.col("n"))
    between = F.struct(((start.x + end.x) / 2).alias("x"), ((start.y + end.y) / 2).alias("y"))
    turned = (F.col("relation_id") + F.col("i")) % 2 == 0
    return parts.select("relation_id", ((F.col("i") * 7) % 11).alias("way_no"),
                        F.when(turned, F.array(end, between, start)).otherwise(F.array(start, between, end)).alias("points"))


@query("stitch_rings", """
SELECT event_id AS relation_id, 0::BIGINT AS ring, true AS closed, (2 * n + 1)::BIGINT AS points, round(n * 2 * r * sin(pi() / n), 6) AS length
FROM (SELECT event_id, 3 + event_id % 7 AS n, 1 + user_id % 5 AS r FROM events)""")
def stitch_rings(spark, sf_dir):
    rings = geo.stitch_rings(event_ways(spark, sf_dir))
    legs = F.zip_with(F.slice("points", 2, F.size("points") - 1), F.slice("points", 1, F.size("points") - 1),
                      lambda p, q: F.hypot(p.x - q.x, p.y - q.y))
    length = F.aggregate(legs, F.lit(0.0), lambda total, leg: total + leg)
    return rings.select("relation_id", "ring", "closed", F.size("points").cast("long").alias("points"),
                        F.round(length, 6).alias("length"))


# --- series ------------------------------------------------------------------------------

YEARS_SQL = """
yearly AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""


YEAR_RANGE_SQL = """
years AS (SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders))) AS y)"""


def year_range(spark, sf_dir) -> list[int]:
    """The years of the orders, first to last: the columns of a wide table have to be known."""
    first, last = roles.table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return list(range(first, last + 1)) if first is not None else []


def yearly_orders(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey"), "year").agg(F.count(F.lit(1)).alias("n"))
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return per_customer.join(customers, "c_custkey").groupBy("nation", "year").agg(F.sum("n").alias("n"))


@query("trend_change", f"""
WITH {YEARS_SQL.strip()}
SELECT nation, min(year) AS first_year, max(year) AS last_year, arg_min(n, year) AS first_value, arg_max(n, year) AS last_value,
       round((arg_max(n, year)::DOUBLE - arg_min(n, year)) / arg_min(n, year) * 100, 0) AS change_percent
FROM yearly GROUP BY ALL""")
def trend_change(spark, sf_dir):
    return reshape.trend_change(yearly_orders(spark, sf_dir), "year", "n", ["nation"])


def wide_years(spark, sf_dir, years):
    counts = [F.sum(F.when(F.col("year") == y, F.col("n")).otherwise(0)).alias(str(y)) for y in years]
    return yearly_orders(spark, sf_dir).groupBy("nation").agg(F.count(F.lit(1)).alias("_years"), *counts).drop("_years")


@query("unpivot_years", f"""
WITH {YEARS_SQL.strip()}, {YEAR_RANGE_SQL.strip()}
SELECT k.nation, CAST(y AS VARCHAR) AS tahun, coalesce(n, 0) AS jumlah
FROM (SELECT DISTINCT nation FROM yearly) k CROSS JOIN years
LEFT JOIN yearly ON yearly.nation = k.nation AND year = y""")
def unpivot_years(spark, sf_dir):
    years = year_range(spark, sf_dir)
    return reshape.to_long(wide_years(spark, sf_dir, years), ["nation"], [str(y) for y in years])


@query("split_union", """
SELECT n_name, CASE WHEN n_regionkey <= 1 THEN 'regency' ELSE 'municipality' END AS section,
       CASE WHEN n_regionkey <= 1 THEN n_nationkey END AS extra FROM nation""")
def split_union(spark, sf_dir):
    nation = roles.table(spark, sf_dir, "nation").withColumn(
        "section", F.when(F.col("n_regionkey") <= 1, "regency").otherwise("municipality"))
    parts = reshape.split_sections(nation, "section", ["regency", "municipality"])
    return reshape.union_all([parts["regency"].select("n_name", "section", F.col("n_nationkey").alias("extra")),
                              parts["municipality"].select("n_name", "section")])


MONTHS_SQL = """
known AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL),
spine AS (SELECT customer, CAST(unnest(generate_series((SELECT min(month) FROM known), (SELECT max(month) FROM known), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM (SELECT DISTINCT customer FROM known)),
joined AS (SELECT customer, month, n FROM spine LEFT JOIN known USING (customer, month))"""


def monthly_known(spark, sf_dir):
    """Order counts per customer and month: a customer orders in few of the months."""
    orders = roles.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.trunc("o_orderdate", "month").alias("month"))
    return orders.groupBy("customer", "month").agg(F.count(F.lit(1)).alias("n"))


def month_ends(spark, sf_dir):
    """The days of the first and the last order."""
    return tuple(roles.table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first())


@query("forward_fill", f"""
WITH {MONTHS_SQL.strip()}
SELECT customer, strftime(month, '%Y-%m') AS month, n,
       last_value(n IGNORE NULLS) OVER (PARTITION BY customer ORDER BY month ROWS UNBOUNDED PRECEDING) AS filled FROM joined""")
def forward_fill(spark, sf_dir):
    filled = reshape.fill_months(monthly_known(spark, sf_dir), "customer", "month", "n", "filled", *month_ends(spark, sf_dir))
    return filled.withColumn("month", F.date_format("month", "yyyy-MM"))


@query("interpolate", f"""
WITH {MONTHS_SQL.strip()},
ends AS (
  SELECT *, last_value(n IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN n IS NOT NULL THEN month END IGNORE NULLS) OVER b AS t0,
         first_value(n IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN n IS NOT NULL THEN month END IGNORE NULLS) OVER a AS t1
  FROM joined WINDOW b AS (PARTITION BY customer ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     a AS (PARTITION BY customer ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT customer, strftime(month, '%Y-%m') AS month, n, round(coalesce(v0 + (v1 - v0) *
       coalesce(date_diff('month', t0, month)::DOUBLE / nullif(date_diff('month', t0, t1), 0), 0), v0, v1)::DOUBLE, 6) AS blended
FROM ends""")
def interpolate(spark, sf_dir):
    blended = reshape.blend_months(monthly_known(spark, sf_dir), "customer", "month", "n", "blended", *month_ends(spark, sf_dir))
    return rounded(blended.withColumns({"month": F.date_format("month", "yyyy-MM"), "blended": F.col("blended").cast("double")}))


@query("monthly_index", """
WITH people AS (SELECT c_nationkey AS nation, count(*) AS people FROM customer GROUP BY ALL),
counts AS (SELECT c_nationkey AS nation, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n
           FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= DATE '1998-01-01' GROUP BY ALL),
rates AS (SELECT nation, month, n::DOUBLE / people * 100000 AS rate FROM counts JOIN people USING (nation))
SELECT nation, month, round(rate, 6) AS rate, round((rate - min(rate) OVER w) / CASE WHEN max(rate) OVER w > min(rate) OVER w
       THEN max(rate) OVER w - min(rate) OVER w ELSE 1.0 END * 100, 6) AS index FROM rates WINDOW w AS (PARTITION BY month)""")
def monthly_index(spark, sf_dir):
    orders = reshape.since(roles.table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01").select(
        F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    per_customer = orders.groupBy("c_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    people = customers.groupBy("nation").agg(F.count(F.lit(1)).alias("people"))
    counts = per_customer.join(customers, "c_custkey").groupBy("nation", "month").agg(F.sum("n").alias("n"))
    rates = index.rate(counts.join(people, "nation"), "n", "people", 100_000, "rate")
    return rounded(reshape.monthly_index(rates, "month", "rate", "index").select("nation", "month", "rate", "index"))


@query("news_spikes", f"""
WITH {NEWS_SQL.strip()},
user_news AS (SELECT sumber AS kecamatan_terdeteksi, CAST(tanggal_publikasi AS DATE) AS day, count(*) AS n FROM news_rows GROUP BY ALL),
daily AS (SELECT s.kecamatan_terdeteksi, s.day, coalesce(n, 0) AS n FROM (
            SELECT kecamatan_terdeteksi, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day
            FROM (SELECT kecamatan_terdeteksi, min(day) AS a, max(day) AS b FROM user_news GROUP BY kecamatan_terdeteksi)) s
          LEFT JOIN user_news USING (kecamatan_terdeteksi, day)),
scored AS (SELECT *, avg(n) OVER w AS mean, stddev_pop(n) OVER w AS deviation, count(n) OVER w AS days_before FROM daily
           WINDOW w AS (PARTITION BY kecamatan_terdeteksi ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT kecamatan_terdeteksi, strftime(day, '%Y-%m-%d') AS day, n, round(mean, 6) AS mean, round(deviation, 6) AS deviation,
       days_before, round((n - mean) / nullif(deviation, 0), 6) AS z FROM scored
WHERE (n - mean) / nullif(deviation, 0) > 2 OR (deviation = 0 AND n > mean)""")
def news_spikes(spark, sf_dir):
    """Spikes per user, whose days are mostly without news: flat histories and gaps are the usual case."""
    news = roles.event_news(spark, sf_dir).select(F.col("sumber").alias("kecamatan_terdeteksi"), "tanggal_publikasi")
    spikes = reshape.news_spikes(news, "kecamatan_terdeteksi", "tanggal_publikasi")
    return rounded(spikes.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


# --- data quality ------------------------------------------------------------------------

@query("quality_rate", """
WITH counts AS (SELECT c_nationkey, count(*) AS people FROM customer GROUP BY ALL),
rates AS (SELECT c_nationkey, people::DOUBLE / sum(people) OVER () * 100000 AS recomputed FROM counts),
stated AS (SELECT *, recomputed + CASE WHEN c_nationkey % 5 = 0 THEN 3.5 ELSE 0.01 END AS stated FROM rates)
SELECT c_nationkey, round(stated, 6) AS stated, round(recomputed, 6) AS recomputed,
       round(abs(stated - recomputed), 6) AS difference FROM stated WHERE abs(stated - recomputed) > 1""")
def quality_rate(spark, sf_dir):
    customers = roles.table(spark, sf_dir, "customer")
    total = customers.agg(F.count(F.lit(1))).scalar()
    counts = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("people")).withColumn("total", total)
    stated = index.rate(counts, "people", "total", 100_000, "stated").withColumn(
        "stated", F.col("stated") + F.when(F.col("c_nationkey") % 5 == 0, 3.5).otherwise(0.01))
    checked = quality.check_rate(stated, "people", "total", "stated", 100_000, 1.0)
    return rounded(checked.select("c_nationkey", "stated", "recomputed", "difference"))


@query("quality_totals", """
SELECT o_orderkey, CAST(stated AS DOUBLE) AS stated, CAST(coalesce(computed, 0) AS DOUBLE) AS computed,
       CAST(abs(stated - coalesce(computed, 0)) AS DOUBLE) AS difference
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS stated FROM orders)
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS computed FROM lineitem GROUP BY ALL)
  ON l_orderkey = o_orderkey WHERE abs(stated - coalesce(computed, 0)) > 100000""")
def quality_totals(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    found = quality.check_totals(lines, orders, "o_orderkey", "price", "total", 100_000)
    return found.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("stated", "computed", "difference")])


@query("quality_row_totals", """
SELECT c_nationkey AS nation, count(*) AS computed, count(*) + 100 AS stated, 100::BIGINT AS difference
FROM customer WHERE c_nationkey = 7 GROUP BY ALL""")
def quality_row_totals(spark, sf_dir):
    counts = roles.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("a"), F.count_if(F.col("c_mktsegment") != "BUILDING").alias("b"))
    stated = counts.withColumn("stated", F.col("a") + F.col("b") + F.when(F.col("nation") == 7, 100).otherwise(0))
    return quality.check_row_totals(stated, ["a", "b"], "stated").select("nation", "computed", "stated", "difference")


@query("quality_column_totals", """
SELECT * FROM (VALUES ('people', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer) + 5, 5::BIGINT),
  ('building', (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING'),
   (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING'), 0::BIGINT)) AS t("column", computed, stated, difference)""")
def quality_column_totals(spark, sf_dir):
    people = [F.count(F.lit(1)).alias("people"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building")]
    customers = roles.table(spark, sf_dir, "customer")
    body = customers.groupBy(F.col("c_nationkey").cast("string").alias("name")).agg(*people)
    total = customers.agg(F.lit("Total").alias("name"), *people).withColumn("people", F.col("people") + 5)
    return quality.check_column_totals(body.unionByName(total), ["people", "building"], F.col("name") == "Total")


@query("unmatched_keys", """
SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY ALL""")
def unmatched_keys(spark, sf_dir):
    known = roles.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    return quality.unmatched_keys(roles.table(spark, sf_dir, "events"), known, "user_id")


@query("repeat_values", """
SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS cents, count(DISTINCT c_custkey) AS keys, min(c_custkey) AS first_key, max(c_custkey) AS last_key
FROM customer GROUP BY ALL HAVING count(DISTINCT c_custkey) >= 2""")
def repeat_values(spark, sf_dir):
    customers = roles.table(spark, sf_dir, "customer").withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    return quality.repeated_values(customers, "cents", "c_custkey")


@query("duplicate_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(roles.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("variants", """
WITH spelled AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN ' ' || p_type ELSE p_type END AS spelling FROM part),
counted AS (SELECT spelling, lower(trim(spelling)) AS normal, count(*) AS n FROM spelled GROUP BY ALL)
SELECT normal, spelling, n, count(*) OVER (PARTITION BY normal) AS spellings FROM counted""")
def variants(spark, sf_dir):
    kind = F.col("p_partkey") % 3
    spelled = F.when(kind == 0, F.upper("p_type")).when(kind == 1, F.concat(F.lit(" "), "p_type")).otherwise(F.col("p_type"))
    return quality.variants(roles.table(spark, sf_dir, "part").select(spelled.alias("v")), "v")


def _misspelt_sql(name: str = "p_name") -> str:
    return f"""CASE c_custkey % 5 WHEN 0 THEN {name} WHEN 1 THEN substr({name}, 1, 1) || substr({name}, 3)
         WHEN 2 THEN substr({name}, 1, 2) || substr({name}, 4, 1) || substr({name}, 3, 1) || substr({name}, 5)
         WHEN 3 THEN ' ' || upper(substr({name}, 1, 1) || 'q' || substr({name}, 3)) ELSE {name} || 'zz' END"""


@query("alias_proposals", f"""
WITH names AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS i FROM (SELECT DISTINCT p_name FROM part)),
spelled AS (
  SELECT DISTINCT lower(trim({_misspelt_sql()})) AS key FROM customer JOIN names ON i = c_custkey % (SELECT count(*) FROM names)),
pairs AS (
  SELECT key, p_name AS proposal, levenshtein(key, p_name) AS distance FROM spelled, names
  WHERE key NOT IN (SELECT p_name FROM names) AND levenshtein(key, p_name) <= 2)
SELECT key, proposal, distance::INTEGER AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY distance, proposal) AS r FROM pairs) WHERE r = 1""")
def alias_proposals(spark, sf_dir):
    """The customers' places in many spellings; the names of the parts are the accepted ones."""
    names = rank.number_rows(roles.table(spark, sf_dir, "part").select("p_name").distinct(), ["p_name"], "i")
    n = names.agg(F.count(F.lit(1))).scalar()
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % n).alias("i"))
    spelled = customers.join(names, "i").select(normalize_key(F.expr(_misspelt_sql())).alias("key"))
    return quality.propose_aliases(spelled, names.select(F.col("p_name").alias("key")), "key")


@query("alias_unmatched", f"""
WITH names AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS i FROM (SELECT DISTINCT p_name FROM part)),
spelled AS (
  SELECT c_custkey, lower(trim({_misspelt_sql()})) AS key FROM customer JOIN names ON i = c_custkey % (SELECT count(*) FROM names)),
near AS (
  SELECT key, p_name, row_number() OVER (PARTITION BY key ORDER BY levenshtein(key, p_name), p_name) AS r
  FROM (SELECT DISTINCT key FROM spelled), names WHERE levenshtein(key, p_name) <= 2)
SELECT coalesce(p_name, spelled.key) AS place, count(*) AS customers FROM spelled LEFT JOIN near ON near.key = spelled.key AND r = 1 GROUP BY ALL""")
def alias_unmatched(spark, sf_dir):
    """The proposals put to use: customers per place after every unknown spelling took its proposed alias."""
    names = rank.number_rows(roles.table(spark, sf_dir, "part").select("p_name").distinct(), ["p_name"], "i")
    n = names.agg(F.count(F.lit(1))).scalar()
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % n).alias("i"))
    spelled = customers.join(names, "i").select(normalize_key(F.expr(_misspelt_sql())).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    proposed = quality.propose_aliases(spelled, names.select(F.col("p_name").alias("key")), "key")
    placed = spelled.join(proposed, "key", "left").select(F.coalesce("proposal", "key").alias("place"), "n")
    return placed.groupBy("place").agg(F.sum("n").alias("customers"))


@query("monthly_health", """
WITH people AS (SELECT c_nationkey AS nation, count(*) AS people FROM customer GROUP BY ALL),
beds AS (SELECT s_nationkey AS nation, count(*) AS beds FROM supplier GROUP BY ALL),
months AS (SELECT c_nationkey AS nation, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n
           FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= DATE '1998-01-01' GROUP BY ALL),
rates AS (
  SELECT m.nation, month, n, n::DOUBLE / people * 100000 AS ir, coalesce(beds, 0)::DOUBLE / people * 10000 AS hfr
  FROM months m JOIN people USING (nation) LEFT JOIN beds USING (nation)),
scaled AS (
  SELECT *, (ir - min(ir) OVER w) / CASE WHEN max(ir) OVER w > min(ir) OVER w THEN max(ir) OVER w - min(ir) OVER w ELSE 1.0 END * 100 AS norm_ir,
         (hfr - min(hfr) OVER w) / CASE WHEN max(hfr) OVER w > min(hfr) OVER w THEN max(hfr) OVER w - min(hfr) OVER w ELSE 1.0 END * 100 AS norm_hfr
  FROM rates WINDOW w AS (PARTITION BY month))
SELECT n_name AS kecamatan, month, n AS cases, round(0.7 * norm_ir + 0.3 * (100 - norm_hfr), 6) AS indeks_kesehatan
FROM scaled JOIN nation ON n_nationkey = nation""")
def monthly_health(spark, sf_dir):
    """The health composite per month: orders of the month are its cases, suppliers the facilities."""
    orders = reshape.since(roles.table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01").select(
        F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    per_customer = orders.groupBy("c_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = roles.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    people = customers.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("jumlah_penduduk"))
    months = per_customer.join(customers, "c_custkey").groupBy("n_nationkey", "month").agg(F.sum("n").alias("kasus_wabah_baseline"))
    beds = (roles.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("total_faskes")))
    base = months.join(people, "n_nationkey").join(nation, "n_nationkey").join(beds, "n_nationkey", "left").fillna(0, ["total_faskes"])
    none = F.lit(0).cast("long")
    rows = base.select(  # a row per place and month, and a key of both
        F.concat_ws("|", "n_name", "month").alias("kecamatan"), "month", "jumlah_penduduk", "kasus_wabah_baseline", "total_faskes", none.alias("jumlah_kasus"),
        none.alias("total_kasus_berita_kriminal"), none.alias("total_kasus_berita_wabah"))
    found = index.dual_index(rows, by="month")
    return rounded(found.select(F.substring_index("kecamatan", "|", 1).alias("kecamatan"), "month",
                                F.col("total_kasus_wabah").alias("cases"), "indeks_kesehatan"))
