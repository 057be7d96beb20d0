"""Table, message, document and CSV writers."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_text, iso_text
from .readers import read_table, table_exists


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder of the session, or in its warehouse where that is not set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/wardrisk/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame with its rows kept in the shared checkpoint folder; Spark removes them with the frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    """Replace a table, schema included."""
    writer = df.write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def overwrite_checked(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the rows of a table; a changed schema is refused."""
    spark = df.sparkSession
    if table_exists(spark, path, fmt):
        shape = [(f.name, f.dataType) for f in df.schema]
        stored = [(f.name, f.dataType) for f in read_table(spark, path, fmt).schema]
        if shape != stored:
            raise ValueError(f"schema of {path} is {stored}, not {shape}")
    df.write.format(fmt).mode("overwrite").save(path)


def counted(df: DataFrame, name: str):
    """The frame with a row counter that fills while it is written, and the counter."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def to_messages(df: DataFrame, id_col: str = "id_berita") -> DataFrame:
    """Key and JSON value of each row as binary, ready for a message topic."""
    return df.select(F.col(id_col).cast("binary").alias("key"),
                     F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"))


def publish_messages(df: DataFrame, topic: str, servers: str | None = None, id_col: str = "id_berita",
                     fmt: str = "kafka", path: str | None = None) -> None:
    """Write keyed JSON messages to Kafka, or to files of another format."""
    writer = to_messages(df, id_col).withColumn("topic", F.lit(topic)).write.format(fmt)
    if fmt == "kafka":
        writer.options(**{"kafka.bootstrap.servers": servers, "kafka.acks": "all",
                          "kafka.compression.type": "gzip", "kafka.retries": "3"}).save()
    else:
        writer.mode("append").save(path)


# --- the published document ------------------------------------------------------------

CRIME_FIELDS = ["kecamatan", "total_kasus_kriminal", "crime_rate", "indeks_kriminalitas"]
HEALTH_FIELDS = ["kecamatan", "total_kasus_wabah", "incidence_rate", "hfr", "indeks_kesehatan"]
NEWS_FIELDS = ["id_berita", "judul", "link", "tanggal_publikasi", "sumber", "kategori",
               "kecamatan_terdeteksi", "deskripsi_mentah"]
def recent_news(news: DataFrame, n: int, place: str = "kecamatan_terdeteksi", ts: str = "tanggal_publikasi",
                id_col: str = "id_berita", unknown: str = "unknown") -> DataFrame:
    """Most recent ``n`` news with a known place; undated news comes last."""
    return news.filter(F.col(place) != unknown).orderBy(F.col(ts).desc_nulls_last(), id_col).limit(n)


def _section(df: DataFrame, name: str, key: str, fields) -> DataFrame:
    """Rows ``(section, position, key, row as JSON)`` of a table that has a ``position``."""
    return df.select(F.lit(name).alias("section"), "position", F.col(key).alias("key"),
                     F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload"))


def _newest(news: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest news with their position; the window sees those only."""
    order = Window.orderBy(F.col("tanggal_publikasi").desc_nulls_last(), "id_berita")
    numbered = recent_news(news, n).withColumn("position", (F.row_number().over(order) - 1).cast("long"))
    return numbered.withColumn("tanggal_publikasi", iso_text("tanggal_publikasi"))


PUBLISHED = "section string, position long, key string, payload string"


def publish_rows(crime: DataFrame, health: DataFrame, news: DataFrame, n: int = 50) -> DataFrame:
    """Rows ``(section, position, key, payload)``: every district by descending index, and the latest ``n`` news.

    Districts are numbered by range partitions, so a table of any size can be published.
    """
    from ..operators.rank import number_rows

    def ranked(df: DataFrame, column: str) -> DataFrame:
        return number_rows(df, [F.col(column).desc_nulls_last(), F.col("kecamatan").asc()], "position")

    return (_section(ranked(crime, "indeks_kriminalitas"), "kriminalitas", "kecamatan", CRIME_FIELDS)
            .unionByName(_section(ranked(health, "indeks_kesehatan"), "kesehatan", "kecamatan", HEALTH_FIELDS))
            .unionByName(_section(_newest(news, n), "berita", "id_berita", NEWS_FIELDS)))


def publish(crime: DataFrame, health: DataFrame, news: DataFrame, n: int = 50, districts: int | None = None,
            last_updated=None) -> DataFrame:
    """One row with the three lists of the reader page: every district of each index, or the first ``districts`` if
    given, and the latest ``n`` news.

    The row holds its lists; :func:`publish_rows` has the same without gathering them.
    """
    from ..operators.rank import number_rows

    def first(df: DataFrame, column: str, fields) -> DataFrame:
        order = [F.col(column).desc_nulls_last(), F.col("kecamatan").asc()]
        if districts is None:
            return number_rows(df, order, "position").select(F.col("position").cast("long").alias("position"), F.struct(*fields).alias("row"))
        top = df.orderBy(*order).limit(districts)
        return top.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("long").alias("position"), F.struct(*fields).alias("row"))

    recent = _newest(news, n).select("position", F.struct(*NEWS_FIELDS).alias("row"))
    parts = {"kriminalitas": first(crime, "indeks_kriminalitas", CRIME_FIELDS),
             "kesehatan": first(health, "indeks_kesehatan", HEALTH_FIELDS), "berita": recent}
    rows = reduce(DataFrame.unionByName, [
        part.select(*[F.struct("position", "row").alias(s) if s == name else F.lit(None).cast(
            f"struct<position: bigint, row: {parts[s].schema['row'].dataType.simpleString()}>").alias(s) for s in parts])
        for name, part in parts.items()])
    stamp = iso_text(F.current_timestamp()) if last_updated is None else F.lit(last_updated)
    listed = [F.transform(F.array_sort(F.collect_list(s)), lambda x: x["row"]).alias(s) for s in parts]
    return rows.agg(*listed).select(stamp.alias("last_updated"), *parts)


#: The parts of the published document in the order of their names: lists of rows, and the text around them.
LISTS = {"kriminalitas": "1-kriminalitas", "kesehatan": "3-kesehatan", "berita": "5-berita"}


def document_lines(rows: DataFrame, last_updated=None) -> DataFrame:
    """The rows of :func:`publish_rows` as lines ``(part, position, line)`` of the published document.

    All lines one after another, in the order of part and position, are one JSON object with the three lists.
    """
    part = F.create_map(*[F.lit(x) for pair in LISTS.items() for x in pair])
    listed = rows.select(F.element_at(part, F.col("section")).alias("part"), F.col("position").cast("long").alias("position"),
                         F.concat(F.when(F.col("position") > 0, ",").otherwise(""), "payload").alias("line"))
    stamp = iso_text(F.current_timestamp()) if last_updated is None else F.lit(last_updated)
    opening = F.concat(F.substring_index(F.to_json(F.struct(stamp.alias("last_updated"))), "}", 1), F.lit(',"kriminalitas":['))
    frame = F.array(*[F.struct(F.lit(name).alias("part"), F.lit(0).cast("long").alias("position"), line.alias("line")) for name, line in (
        ("0-open", opening), ("2-next", F.lit('],"kesehatan":[')), ("4-next", F.lit('],"berita":[')), ("6-close", F.lit("]}")))])
    return listed.unionByName(rows.sparkSession.range(1).select(F.inline(frame)))


def write_document_lines(lines: DataFrame, path: str) -> None:
    """Text files that hold the document if read in the order of their names, folders first; no list is held anywhere.

    The lines are dealt out by ranges of their order, so a task writes a stretch of it.
    """
    (lines.repartitionByRange("part", "position").sortWithinPartitions("part", "position")
     .select("part", "line").write.mode("overwrite").partitionBy("part").text(path))


def write_document(doc: DataFrame, path: str) -> None:
    doc.write.mode("overwrite").option("ignoreNullFields", False).json(path)


# --- CSV export -------------------------------------------------------------------------

def csv_lines(df: DataFrame, columns: dict[str, str], decimals=(), digits: int = 2):
    """Quoted text line per row and the header line; ``decimals`` get a fixed number of digits."""
    def quoted(text):
        return F.concat(F.lit('"'), F.replace(F.coalesce(text, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))

    fields = [quoted(fixed_text(c, digits) if c in decimals else F.col(c).cast("string")) for c in columns]
    header = ",".join(f'"{title}"' for title in columns.values())
    return df.select(F.concat_ws(",", *fields).alias("line")), header


def write_csv(df: DataFrame, path: str, columns: dict[str, str], decimals=(), digits: int = 2) -> None:
    """CSV files with all fields quoted, a header and a byte order mark in each file.

    The lines are finished text, so the CSV writer only adds the header line.  Rows keep the order
    of ``df`` within a file; an ordered frame gives files that follow one another.
    """
    lines, header = csv_lines(df, columns, decimals, digits)
    (lines.withColumnRenamed("line", "﻿" + header).write.mode("overwrite")
     .options(header=True, quote="", escape="", sep="\u0001").csv(path))
