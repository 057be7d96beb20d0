"""The bronze, silver and gold jobs over one root folder.

A job reads tables, writes tables and returns nothing else; each table is written once
and read back by the next job, so no plan is computed twice and a lost executor costs
only its own tasks.  ``fmt`` is the table format (``delta`` where the connector exists).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import NEWS_SCHEMA, clean_table, dedup_news
from ..operators.index import (crime_index, disease_per_key, facilities_per_key, health_index)
from ..operators.quality import unmatched_keys
from ..operators.topics import topic_counts
from ..sources import readers, writers
from ..streaming import news as streams


@dataclass(frozen=True)
class Layout:
    """Table paths under a root folder."""

    root: str
    fmt: str = "parquet"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def ingest_batch(spark: SparkSession, layout: Layout, facilities: str, disease: str) -> dict[str, int]:
    """Registry and case files plus the declared baseline to bronze; returns the row counts.

    The counts come from the writes themselves, the sources are read once.
    """
    frames = {
        "tbl_raw_faskes_baseline": readers.with_lineage(readers.read_delimited(spark, facilities, readers.FACILITY_SCHEMA)),
        "tbl_raw_disease_baseline": readers.with_lineage(readers.read_delimited(spark, disease, readers.DISEASE_SCHEMA)),
        "tbl_static_crime_baseline": readers.crime_baseline(spark).withColumn("bronze_ingested_at", F.current_timestamp()),
    }
    rows = {}
    for name, df in frames.items():
        observed, counter = writers.counted(df, name)
        writers.overwrite(observed, layout.bronze(name), layout.fmt)
        rows[name] = counter.get["rows"]
    return rows


def ingest_news(messages: DataFrame, layout: Layout, block: bool = True, by_date: bool = False):
    """Message stream to the raw news table, partitioned by message date if wanted."""
    raw = streams.envelope(messages)
    if by_date:
        raw = raw.withColumn("kafka_date", F.to_date("kafka_timestamp"))
    return streams.drain(raw, layout.bronze("tbl_raw_news"), layout.checkpoint("bronze_news_stream"),
                         layout.fmt, block, ["kafka_date"] if by_date else ())


def clean_batch(spark: SparkSession, layout: Layout) -> None:
    """Facilities, disease cases and crime baseline to silver."""
    jobs = {
        ("tbl_raw_faskes_baseline", "tbl_clean_faskes"): dict(required=["kecamatan", "nama_faskes"], names=["kecamatan"]),
        ("tbl_raw_disease_baseline", "tbl_clean_disease"): dict(
            required=["kecamatan", "jenis_penyakit"], names=["kecamatan"], casts={"jumlah_kasus": "int"}),
        ("tbl_static_crime_baseline", "tbl_clean_crime_baseline"): dict(
            required=["kecamatan"], names=["kecamatan"],
            casts={"jumlah_kasus": "int", "jumlah_penduduk": "int", "crime_rate": "float"}),
    }
    for (source, target), rules in jobs.items():
        df = clean_table(readers.read_table(spark, layout.bronze(source), layout.fmt), **rules)
        writers.overwrite(df.withColumn("silver_processed_at", F.current_timestamp()), layout.silver(target), layout.fmt)


def clean_news_stream(spark: SparkSession, layout: Layout, block: bool = True, gazetteer=None, by_place: bool = False):
    """Raw news to clean news, partitioned by place if wanted; None if there is no raw news yet."""
    raw_schema = streams.envelope(spark.createDataFrame([], streams.ENVELOPE)).schema
    raw = streams.open_stream_or_none(spark, layout.fmt, layout.bronze("tbl_raw_news"), raw_schema)
    if raw is None:
        return None
    return streams.drain(streams.clean_news(raw, gazetteer), layout.silver("tbl_clean_news"),
                         layout.checkpoint("silver_news"), layout.fmt, block, ["kecamatan_terdeteksi"] if by_place else ())


def build_gold(spark: SparkSession, layout: Layout, dedup: bool = False, strict: bool = False, **topic_options) -> bool:
    """News topics, both indices and the report of keys the base does not know.

    With ``strict`` nothing is written when there is no news with a known place.
    """
    silver = {name: readers.read_table(spark, layout.silver(name), layout.fmt)
              for name in ("tbl_clean_crime_baseline", "tbl_clean_disease", "tbl_clean_faskes")}
    news = readers.read_or_empty(spark, layout.silver("tbl_clean_news"), NEWS_SCHEMA, layout.fmt)
    if dedup:
        news = dedup_news(news)
    topics = topic_counts(news, strict=strict, **topic_options)
    if topics is None:
        return False
    writers.overwrite(topics.counts, layout.gold("news_counts"), layout.fmt)
    writers.overwrite(topics.metrics, layout.gold("topic_metrics"), layout.fmt)
    topics.release()
    counts = readers.read_table(spark, layout.gold("news_counts"), layout.fmt)

    base = silver["tbl_clean_crime_baseline"]
    disease, facilities = disease_per_key(silver["tbl_clean_disease"]), facilities_per_key(silver["tbl_clean_faskes"])
    now = F.current_timestamp()
    crime = crime_index(base, counts).withColumn("gold_processed_at", now)
    health = health_index(base, disease, facilities, counts).withColumn("gold_processed_at", now)
    writers.overwrite_checked(crime, layout.gold("tbl_index_kriminalitas"), layout.fmt)
    writers.overwrite_checked(health, layout.gold("tbl_index_kesehatan"), layout.fmt)
    unmatched = [unmatched_keys(df, base, "kecamatan").withColumn("table_name", F.lit(name))
                 for name, df in silver.items() if name != "tbl_clean_crime_baseline"]
    writers.overwrite(unmatched[0].unionByName(unmatched[1]), layout.gold("unmatched_keys"), layout.fmt)
    return True


def export_document(spark: SparkSession, layout: Layout, path: str, n: int = 50) -> None:
    """The document for the reader page from the gold tables and the latest news: all districts, ``n`` news.

    It is written as lines in order, in files whose names give the order, so no list has to fit into a row.  The rows with
    their positions are in ``<path>_rows``.
    """
    crime = readers.read_table(spark, layout.gold("tbl_index_kriminalitas"), layout.fmt)
    health = readers.read_table(spark, layout.gold("tbl_index_kesehatan"), layout.fmt)
    news = readers.read_or_empty(spark, layout.silver("tbl_clean_news"), NEWS_SCHEMA, layout.fmt)
    beside = f"{path.rstrip('/')}_rows"
    writers.write_document(writers.publish_rows(crime, health, news, n), beside)
    writers.write_document_lines(writers.document_lines(spark.read.schema(writers.PUBLISHED).json(beside)), path)


def verify_layer(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One row per table: whether it is there, its rows and its columns."""
    parts, missing = [], []
    for name, path in tables.items():
        if readers.table_exists(spark, path, fmt):
            df = readers.read_table(spark, path, fmt)
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), F.lit(True).alias("present"), "rows", F.lit(len(df.columns)).alias("columns")))
        else:
            missing.append((name, False, None, None))
    schema = "table_name string, present boolean, rows long, columns int"
    report = spark.createDataFrame(missing, schema)
    for part in parts:
        report = report.unionByName(part)
    return report
