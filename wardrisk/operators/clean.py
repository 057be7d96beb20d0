"""Cleaning, parsing, filtering and de-duplication of tables and news."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize_key, standardize_name, to_ts

NEWS_PAYLOAD = T.StructType([
    T.StructField("id_berita", T.StringType()),
    T.StructField("judul", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("tanggal_publikasi", T.StringType()),
    T.StructField("sumber", T.StringType()),
    T.StructField("kategori", T.StringType()),
    T.StructField("deskripsi_mentah", T.StringType()),
])

NEWS_SCHEMA = T.StructType([
    T.StructField("id_berita", T.StringType()),
    T.StructField("judul", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("tanggal_publikasi", T.TimestampType()),
    T.StructField("sumber", T.StringType()),
    T.StructField("kategori", T.StringType()),
    T.StructField("deskripsi_mentah", T.StringType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("kecamatan_terdeteksi", T.StringType()),
    T.StructField("silver_processed_at", T.TimestampType()),
])


def require(df: DataFrame, columns) -> DataFrame:
    """Rows in which every listed column is present."""
    return df.dropna(subset=list(columns))


def clean_table(df: DataFrame, required=(), names=(), casts: dict[str, str] | None = None,
                dedup: bool = True) -> DataFrame:
    """Drop repeated rows and rows without required values, tidy names, cast numbers.

    Values that cannot be cast become NULL.  The filter comes first in the text but
    does not depend on the order: Catalyst moves it below the de-duplication.
    """
    out = df.dropDuplicates() if dedup else df
    if required:
        out = require(out, required)
    changes: dict[str, Column] = {c: standardize_name(c) for c in names}
    changes.update({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()})
    return out.withColumns(changes) if changes else out


def parse_json(df: DataFrame, schema: T.StructType, payload: str, keep=()) -> DataFrame:
    """Flatten a JSON text column; malformed rows stay, with NULL fields."""
    parsed = df.withColumn("_data", F.from_json(payload, schema))
    return parsed.select("_data.*", *keep)


def parse_news(df: DataFrame, payload: str = "raw_value", schema: T.StructType = NEWS_PAYLOAD,
               ts: str = "tanggal_publikasi", keep=("kafka_timestamp",)) -> DataFrame:
    """Raw message to typed news columns (batch or stream)."""
    flat = parse_json(df, schema, payload, keep)
    return flat.withColumn(ts, to_ts(ts))


def exclude_value(df: DataFrame, column: str, value: str = "unknown") -> DataFrame:
    """Rows whose column is neither NULL nor the sentinel."""
    return df.filter(F.col(column) != value)


def news_filter(df: DataFrame, search: str | None = None, category: str | None = None,
                place: str | None = None, days: int | None = None, as_of=None,
                title: str = "judul", kind: str = "kategori", key: str = "kecamatan_terdeteksi",
                ts: str = "tanggal_publikasi") -> DataFrame:
    """Optional conditions joined by AND; with ``days`` set, a NULL date never passes."""
    out = df
    if days is not None:
        end = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        out = out.filter(F.col(ts) >= end - F.make_dt_interval(F.lit(days)))
    if category is not None:
        out = out.filter(F.col(kind) == category)
    if place is not None:
        out = out.filter(normalize_key(key) == normalize_key(F.lit(place)))
    if search:
        out = out.filter(F.contains(F.lower(title), F.lit(search.lower().strip())))
    return out


def name_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive substring search."""
    return df.filter(F.contains(F.lower(column), F.lit(text.lower().strip())))


def find_place(df: DataFrame, column: str, text: str, order: str) -> DataFrame:
    """First row, in the given descending order, whose normalised name starts with the text."""
    query = text.lower().strip()
    hits = df.filter(F.startswith(normalize_key(column), F.lit(query)) & F.lit(query != ""))
    return hits.orderBy(F.desc(order), column).limit(1)


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first in the given order.

    The rank filter reaches below the shuffle (window group limit), so each task
    sends at most one row per key, also for a hot key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def distinct_items(df: DataFrame, keys, order=()) -> DataFrame:
    """One row per key, the first in the given order; rows with a NULL in the key have no identity and all stay.

    Ties go by the other columns, so the row that stays does not depend on how the rows are spread.
    """
    keys = list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    ties = [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed, ranked_by = df.filter(known), [*order, *ties]
    firsts = first_per_key(keyed, keys, ranked_by) if ranked_by else keyed.dropDuplicates(keys)
    return firsts.unionByName(df.filter(~known))


def dedup_news(df: DataFrame, id_col: str = "id_berita", ts: str = "kafka_timestamp") -> DataFrame:
    """Batch counterpart of the stream de-duplication: the earliest row per id, and all rows without an id."""
    return distinct_items(df, [id_col], [F.col(ts).asc_nulls_last()])


def news_identity(link: str = "link", title: str = "judul") -> Column:
    """What a reader's page counts as the same item: the link, else the title."""
    return F.coalesce(F.when(F.col(link) != "", F.col(link)), F.col(title))


def new_items(incoming: DataFrame, seen: DataFrame, keys, order=()) -> DataFrame:
    """One incoming row per key that was not seen before, the first in the given order; rows without a key stay."""
    known = seen.select(*keys).distinct()
    return distinct_items(incoming, keys, order).join(known, list(keys), "left_anti")
