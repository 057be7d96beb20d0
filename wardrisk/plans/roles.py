"""What the test tables stand for.

District = nation, inhabitants = customers, crime cases = returned line items, disease
cases = line quantity, facilities = suppliers, news = events (by type) or documents (by
text).  Detail rows are counted per order, per customer, then per nation: every step
combines rows before it shuffles, and a step reuses the partitioning of the join before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CRIME_LABEL, HEALTH_LABEL
from ..operators.index import crime_index, dual_index, health_index

# Places to look for in the documents, in priority order; some share words.
PLACES = ["thanedble the", "attion to", "thtion", "de la", "eriner", "attion", "tiontion", "of the",
          "la ci", "und", "des", "una"]

# Event types that play the two news categories.
EVENT_LABELS = {"error": CRIME_LABEL, "signup": HEALTH_LABEL}

AS_OF = "2024-01-31"


# Declared, so that opening a table needs no job that looks into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, read as it is: its files and ``spark.sql.files.maxPartitionBytes`` set the tasks."""
    return table(spark, sf_dir, name)


def per_nation(detail: DataFrame, customer: str, customers: DataFrame, measures) -> DataFrame:
    """Sum measures per customer, then per nation of the customer."""
    by_customer = detail.groupBy(F.col(customer).alias("c_custkey")).agg(*[F.sum(m).alias(m) for m in measures])
    joined = by_customer.join(customers.select("c_custkey", "c_nationkey"), "c_custkey")
    return joined.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(*[F.sum(m).alias(m) for m in measures])


def named(df: DataFrame, nation: DataFrame) -> DataFrame:
    return df.join(nation.select("n_nationkey", F.col("n_name").alias("kecamatan")), "n_nationkey").drop("n_nationkey")


def line_measures(returned: bool = False, quantity: bool = False) -> dict:
    """Aggregates over line items: returned lines (crime cases), quantity (disease cases)."""
    out = {}
    if returned:
        out["jumlah_kasus"] = F.count_if(F.col("l_returnflag") == "R")
    if quantity:
        out["kasus_wabah_baseline"] = F.sum(F.col("l_quantity").cast("long"))
    return out


def districts(spark: SparkSession, sf_dir: str, returned: bool = False, quantity: bool = False) -> DataFrame:
    """Base table: kecamatan, region, jumlah_penduduk and the wanted line item measures.

    Lines are counted per order (which partitions them for the join with the orders), then
    per customer (likewise for the customers), then per nation together with the customers.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    measures = line_measures(returned, quantity)
    if measures:
        lines = table(spark, sf_dir, "lineitem")
        if not quantity:
            lines = lines.filter("l_returnflag = 'R'")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*[a.alias(m) for m, a in measures.items()])
        per_customer = (per_order.join(orders, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey"))
                        .agg(*[F.sum(m).alias(m) for m in measures]))
        customers = customers.join(per_customer, "c_custkey", "left")
    people = customers.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("jumlah_penduduk"), *[F.sum(m).alias(m) for m in measures])
    base = table(spark, sf_dir, "nation").join(people, "n_nationkey", "left").fillna(0, ["jumlah_penduduk", *measures])
    return base.withColumnsRenamed({"n_name": "kecamatan", "n_regionkey": "region"}).drop("n_nationkey")


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey"))
              .agg(F.count(F.lit(1)).alias("total_faskes")))
    return named(counts, table(spark, sf_dir, "nation"))


def label_of(event_type: str = "event_type"):
    expr = F
    for value, label in EVENT_LABELS.items():
        expr = expr.when(F.col(event_type) == value, F.lit(label))
    return expr


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News per district and label; events are counted per user before the join."""
    per_user = (table(spark, sf_dir, "events").filter(F.col("event_type").isin(*EVENT_LABELS))
                .groupBy("user_id").agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in EVENT_LABELS]))
    counts = named(per_nation(per_user, "user_id", table(spark, sf_dir, "customer"), list(EVENT_LABELS)),
                   table(spark, sf_dir, "nation"))
    return counts.select("kecamatan", F.col("error").alias("total_kasus_berita_kriminal"),
                         F.col("signup").alias("total_kasus_berita_wabah"))


def event_news(spark: SparkSession, sf_dir: str, types=None) -> DataFrame:
    """Events as news rows: id, place (nation of the user), label, title, date."""
    events = table(spark, sf_dir, "events")
    if types is not None:
        events = events.filter(F.col("event_type").isin(*types))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("kecamatan_terdeteksi"))
    placed = events.join(customers, "user_id", "left").join(nation, "n_nationkey", "left")
    return placed.select(
        F.col("event_id").cast("string").alias("id_berita"), "event_id",
        F.concat(F.lit("Event "), "event_type", F.lit(" "), F.col("event_id").cast("string")).alias("judul"),
        F.concat(F.lit("https://example.org/"), "event_type", F.lit("/"), F.col("event_id").cast("string")).alias("link"),
        F.col("ts").cast("timestamp").alias("tanggal_publikasi"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("sumber"),
        F.col("event_type").alias("kategori"),
        F.coalesce("kecamatan_terdeteksi", F.lit("unknown")).alias("kecamatan_terdeteksi"),
        F.col("props").alias("deskripsi_mentah"))


def crime(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    return crime_index(districts(spark, sf_dir, returned=True), event_counts(spark, sf_dir), by=by)


def health(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    if by is None:
        return dual_index(districts(spark, sf_dir, returned=True, quantity=True), [event_counts(spark, sf_dir), facilities(spark, sf_dir)]).select(
            "kecamatan", "jumlah_penduduk", "kasus_wabah_baseline", "total_kasus_berita_wabah", "total_faskes", "total_kasus_wabah",
            "incidence_rate", "hfr", "norm_ir", "norm_hfr", "indeks_kesehatan")
    disease = districts(spark, sf_dir, quantity=True).select("kecamatan", "kasus_wabah_baseline")
    return health_index(districts(spark, sf_dir), disease, facilities(spark, sf_dir), event_counts(spark, sf_dir), by=by)


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both indices per district from one pass over each table."""
    base = districts(spark, sf_dir, returned=True, quantity=True)
    return dual_index(base, [event_counts(spark, sf_dir), facilities(spark, sf_dir)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news texts: the first line is the title, the rest the body."""
    docs = text_table(spark, sf_dir, "documents")
    cut = F.locate("\n", F.col("text"))
    return docs.select(
        "doc_id", "lang", "source",
        F.when(cut > 0, F.expr("substring(text, 1, locate('\n', text) - 1)")).otherwise(F.col("text")).alias("judul"),
        F.when(cut > 0, F.expr("substring(text, locate('\n', text) + 1)")).alias("deskripsi_mentah"))


# --- SQL twins of the shared parts ------------------------------------------------------

PEOPLE_SQL = """
base AS (
  SELECT n.n_name AS kecamatan, n.n_nationkey AS nk, n.n_regionkey AS region, count(c.c_custkey) AS jumlah_penduduk
  FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY ALL),
news AS (
  SELECT c.c_nationkey AS nk, count(*) FILTER (event_type = 'error') AS nc, count(*) FILTER (event_type = 'signup') AS nh
  FROM events e JOIN customer c ON c.c_custkey = e.user_id GROUP BY ALL),
lines AS (
  SELECT c.c_nationkey AS nk, count(*) FILTER (l_returnflag = 'R') AS returned,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer c ON c_custkey = o_custkey GROUP BY ALL),
sup AS (SELECT s_nationkey AS nk, count(*) AS suppliers FROM supplier GROUP BY ALL)"""

CRIME_SQL = PEOPLE_SQL + """,
crime0 AS (
  SELECT kecamatan, region, coalesce(returned, 0) AS kasus_kriminal_baseline, jumlah_penduduk,
         coalesce(nc, 0) AS total_kasus_berita_kriminal,
         coalesce(returned, 0) + coalesce(nc, 0) AS total_kasus_kriminal,
         CAST(coalesce(returned, 0) + coalesce(nc, 0) AS DOUBLE) / nullif(jumlah_penduduk, 0) * 100000 AS crime_rate
  FROM base LEFT JOIN lines USING (nk) LEFT JOIN news USING (nk)),
crime AS (
  SELECT *, (crime_rate - min(crime_rate) OVER ()) /
         CASE WHEN max(crime_rate) OVER () - min(crime_rate) OVER () > 0
              THEN max(crime_rate) OVER () - min(crime_rate) OVER () ELSE 1.0 END * 100 AS indeks_kriminalitas
  FROM crime0)"""

HEALTH_SQL = """
health0 AS (
  SELECT kecamatan, region, jumlah_penduduk, coalesce(quantity, 0) AS kasus_wabah_baseline,
         coalesce(nh, 0) AS total_kasus_berita_wabah, coalesce(suppliers, 0) AS total_faskes,
         coalesce(quantity, 0) + coalesce(nh, 0) AS total_kasus_wabah,
         CAST(coalesce(quantity, 0) + coalesce(nh, 0) AS DOUBLE) / nullif(jumlah_penduduk, 0) * 100000 AS incidence_rate,
         CAST(coalesce(suppliers, 0) AS DOUBLE) / nullif(jumlah_penduduk, 0) * 10000 AS hfr
  FROM base LEFT JOIN lines USING (nk) LEFT JOIN news USING (nk) LEFT JOIN sup USING (nk)),
health1 AS (
  SELECT *, (incidence_rate - min(incidence_rate) OVER ()) / CASE WHEN max(incidence_rate) OVER () > min(incidence_rate) OVER ()
              THEN max(incidence_rate) OVER () - min(incidence_rate) OVER () ELSE 1.0 END * 100 AS norm_ir,
         (hfr - min(hfr) OVER ()) / CASE WHEN max(hfr) OVER () > min(hfr) OVER ()
              THEN max(hfr) OVER () - min(hfr) OVER () ELSE 1.0 END * 100 AS norm_hfr
  FROM health0),
health AS (SELECT *, 0.7::DOUBLE * norm_ir + 0.3::DOUBLE * (100 - norm_hfr) AS indeks_kesehatan FROM health1)"""

BOTH_SQL = CRIME_SQL + "," + HEALTH_SQL

NEWS_SQL = """
news_rows AS (
  SELECT CAST(event_id AS VARCHAR) AS id_berita, event_id,
         'Event ' || event_type || ' ' || CAST(event_id AS VARCHAR) AS judul,
         'https://example.org/' || event_type || '/' || CAST(event_id AS VARCHAR) AS link,
         ts AS tanggal_publikasi, 'user ' || CAST(user_id AS VARCHAR) AS sumber, event_type AS kategori,
         coalesce(n_name, 'unknown') AS kecamatan_terdeteksi, props AS deskripsi_mentah
  FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey)"""

DOCUMENTS_SQL = r"""
docs AS (
  SELECT doc_id, lang, source,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS judul,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS deskripsi_mentah
  FROM documents)"""

CLEAN_SQL = "lower(regexp_replace({0}, '[^a-zA-Z\\s]', ' ', 'g'))"
