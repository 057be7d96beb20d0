"""Table, file and feed readers.  The table format is an argument everywhere."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (decode_entities, fixed, html_to_text, is_article_link, published_at,
                         publisher, stable_id)

CRIME_SCHEMA = T.StructType([
    T.StructField("kecamatan", T.StringType(), False),
    T.StructField("jumlah_kasus", T.IntegerType(), False),
    T.StructField("jumlah_penduduk", T.IntegerType(), False),
    T.StructField("crime_rate", T.FloatType(), False),
    T.StructField("tahun_baseline", T.IntegerType(), False),
    T.StructField("sumber_data", T.StringType(), False),
])

# Columns of the registry and case files, in file order.
_GEO = ["kode_provinsi", "nama_provinsi", "kode_kota", "nama_kota", "kode_kecamatan_kemendagri",
        "kode_kecamatan_bps", "kecamatan"]
FACILITY_SCHEMA = ", ".join(f"{c} string" for c in [*_GEO, "jenis_faskes", "penyelenggara_faskes", "nama_faskes", "periode"]) + ", tahun int"
DISEASE_SCHEMA = ", ".join(f"{c} string" for c in [*_GEO, "nama_faskes", "jenis_penyakit", "jumlah_kasus", "periode"]) + ", tahun int"


def crime_baseline(spark: SparkSession) -> DataFrame:
    """The declared 31-row crime baseline."""
    rows = [(name, cases, people, rate, fixed.BASELINE_YEAR, fixed.BASELINE_SOURCES[source])
            for name, cases, people, rate, source in fixed.CRIME_BASELINE]
    return spark.createDataFrame(rows, CRIME_SCHEMA)


def city_history(spark: SparkSession) -> DataFrame:
    """Reported cases of the whole city per year."""
    return spark.createDataFrame(fixed.CITY_HISTORY, "tahun int, jumlah int")


def with_lineage(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add the ingestion time and the source file (the file read, or a given name)."""
    name = F.col("_metadata.file_name") if source is None else F.lit(source)
    return df.withColumns({"bronze_source_file": name, "bronze_ingested_at": F.current_timestamp()})


def read_delimited(spark: SparkSession, path, schema=None, sep: str = ";", **options) -> DataFrame:
    """Delimited files with a header.  Give a schema; inference reads the files twice."""
    reader = spark.read.options(header=True, sep=sep, encoding="UTF-8", **options)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST", "DELTA_TABLE_NOT_FOUND",
                                    "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        read_table(spark, path, fmt)
        return True
    except AnalysisException as error:
        if _missing(error):
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or a typed empty relation if it is not there yet; other errors are raised."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)


# --- landed feeds ---------------------------------------------------------------------

FEED_SCHEMA = ("title string, link string, pubDate string, "
               "source struct<_VALUE: string, _url: string>, summary string, description string")


def read_feed(spark: SparkSession, path, schema: str = FEED_SCHEMA) -> DataFrame:
    """Items of landed RSS files."""
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)


def feed_items(items: DataFrame, category: str | Column, now: Column | None = None) -> DataFrame:
    """RSS items to the news payload: usable links only, stable id, plain text."""
    body = F.coalesce(F.when(F.col("summary") != "", F.col("summary")), "description")
    return items.filter(is_article_link("link")).select(
        stable_id("link").alias("id_berita"),
        F.coalesce("title", F.lit("")).alias("judul"),
        "link",
        published_at("pubDate", now).alias("tanggal_publikasi"),
        publisher("source._VALUE", "title").alias("sumber"),
        (F.lit(category) if isinstance(category, str) else category).alias("kategori"),
        html_to_text(body).alias("deskripsi_mentah"),
        F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"))


def ingest_statistics(items: DataFrame, seen: DataFrame, error: str | None = None, cycle: str | None = None) -> DataFrame:
    """One row: items fetched, usable, repeated in the batch or already known, to be sent, errors and cycles.

    ``error`` names a column with the message of a fetch that failed; such rows are no items.
    ``cycle`` names a column with the round that brought the row; rows with an error count there too.
    """
    failed = F.lit(False) if error is None else F.col(error).isNotNull()
    rounds = F.lit(1).cast("long") if cycle is None else F.count_distinct(cycle)
    got = items.filter(~failed)
    usable = got.filter(is_article_link("link")).select(stable_id("link").alias("id_berita"))
    known = seen.select("id_berita").distinct().withColumn("_known", F.lit(True))
    per_id = usable.groupBy("id_berita").agg(F.count(F.lit(1)).alias("n")).join(known, "id_berita", "left")
    stats = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("usable"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), 1)), F.lit(0)).alias("sent"))
    all_rows = items.agg(F.struct(F.count_if(~failed).alias("fetched"), F.count_if(failed).alias("errors"), rounds.alias("cycles"))).scalar()
    counted = stats.withColumn("_all", all_rows)
    return counted.select("_all.fetched", "usable", (F.col("usable") - F.col("sent")).alias("duplicates"), "sent", "_all.errors", "_all.cycles")


# --- period files ---------------------------------------------------------------------

def file_fingerprints(spark: SparkSession, path) -> DataFrame:
    """One row per file with a fingerprint of its lines, computed line by line.

    Files that hold the same lines have the same fingerprint; no file is loaded whole.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.bit_xor(F.xxhash64("value")).alias("h1"),
        F.sum(F.xxhash64(F.lit("s"), "value").cast("decimal(38,0)")).alias("h2"))


def file_stem(file: Column) -> Column:
    """Name of a file without its folders and its extension: copies of a period share it."""
    return F.regexp_extract(file, r"([^/]*?)(?:\.[^./]*)?$", 1)


def distinct_files(spark: SparkSession, path, period=file_stem) -> DataFrame:
    """The first path of each group of files of one period with the same lines.

    ``period`` makes a column out of the path of a file.  Equal files of different periods all stay.
    """
    return file_fingerprints(spark, path).groupBy(period(F.col("file")).alias("period"), "lines", "h1", "h2").agg(
        F.min("file").alias("file"), F.count(F.lit(1)).alias("copies")).select("file", "period", "lines", "copies")


def read_periods(spark: SparkSession, path, schema=None, sep: str = ",", period=file_stem) -> DataFrame:
    """One file per period, read together, each row with its file and period; a period's repeated files once."""
    data = read_delimited(spark, path, schema, sep, enforceSchema=False) if schema else read_delimited(spark, path, None, sep)
    data = data.withColumn("_file", F.col("_metadata.file_path"))
    data = data.withColumn("source_file", F.col("_metadata.file_name"))
    keep = distinct_files(spark, path, period).select(F.col("file").alias("_file"), "period")
    return data.join(keep, "_file").drop("_file")


# --- report sheets and HTML tables ----------------------------------------------------

def read_report(spark: SparkSession, path, cells: int) -> DataFrame:
    """Raw cells ``c0..`` of report sheets with their file and line number.

    Sheets have line breaks inside quoted cells, so a file is not split.
    """
    schema = ", ".join(f"c{i} string" for i in range(cells))
    raw = spark.read.options(header=False, multiLine=True, encoding="UTF-8").schema(schema).csv(path)
    return raw.select(F.col("_metadata.file_path").alias("report"), F.monotonically_increasing_id().alias("line"), "*")


def html_table_rows(df: DataFrame, html: str, keep=(), escaped: bool = True,
                    row_tag: str = "tr", cell_tags=("td", "th")) -> DataFrame:
    """Table rows of an HTML text: kept columns, row number, plain cell texts."""
    markup = decode_entities(html) if escaped else F.col(html)
    rows = F.regexp_extract_all(markup, F.lit(rf"(?is)<{row_tag}\b[^>]*>(.*?)</{row_tag}\s*>"), F.lit(1))
    cell = "|".join(cell_tags)
    # The outer form: the inner one adds a filter that would search every text a second time.
    table = df.select(*keep, F.posexplode_outer(rows).alias("row", "_row")).filter("row IS NOT NULL")
    cells = F.regexp_extract_all("_row", F.lit(rf"(?is)<(?:{cell})\b[^>]*>(.*?)</(?:{cell})\s*>"), F.lit(1))
    return table.select(*keep, "row", F.transform(cells, html_to_text).alias("cells"))


def read_envelope(spark: SparkSession, path) -> DataFrame:
    """JSON envelopes whose ``data.table`` field is escaped HTML."""
    schema = "status string, data struct<table_id: long, title: string, table: string, cr_date: string>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return raw.select("status", "data.*")


# --- the published document ------------------------------------------------------------

DOCUMENT_SCHEMA = """last_updated string,
kriminalitas array<struct<kecamatan: string, total_kasus_kriminal: bigint, crime_rate: double, indeks_kriminalitas: double>>,
kesehatan array<struct<kecamatan: string, total_kasus_wabah: bigint, incidence_rate: double, hfr: double, indeks_kesehatan: double>>,
berita array<struct<id_berita: string, judul: string, link: string, tanggal_publikasi: string, sumber: string, kategori: string, kecamatan_terdeteksi: string, deskripsi_mentah: string>>"""


def read_document(spark: SparkSession, path) -> dict[str, DataFrame]:
    """The published document as its three relations, with the position in each list: one JSON file, or files of lines."""
    from .writers import LISTS

    if any("/part=" in file for file in spark.read.text(path).inputFiles()[:1]):
        return {name: _listed(spark, path, part, name) for name, part in LISTS.items()}
    doc = spark.read.schema(DOCUMENT_SCHEMA).json(path, multiLine=True)
    return {name: doc.select(F.posexplode(name).alias("position", "_r")).select("position", "_r.*")
            for name in ("kriminalitas", "kesehatan", "berita")}


def _listed(spark: SparkSession, path, part: str, name: str) -> DataFrame:
    """The rows of one list; their position is the number of their line in the files of the part."""
    from ..operators.rank import number_rows

    row = T.StructType.fromDDL(DOCUMENT_SCHEMA)[name].dataType.elementType
    lines = spark.read.schema("value string, part string").text(path).filter(F.col("part") == part)
    placed = lines.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("line"))
    numbered = number_rows(placed, ["file", "block", "line"], "position")
    return numbered.select("position", F.from_json(F.regexp_replace("value", "^,", ""), row).alias("_r")).select("position", "_r.*")
