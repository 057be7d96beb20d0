"""Geo-parsing, map points, news choropleth and boundary assembly."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import band, clean_text, fixed, normalize_key, resolve_alias
from .rank import number_rows
from .rings import LINKS, link_partition

PLACE = "kecamatan_terdeteksi"

def literal_dimension(spark, rows, names) -> DataFrame:
    """Small literal table as a pure expression, so that its size is known to the optimizer."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# --- geo-parsing -------------------------------------------------------------------

def _cleaned(names) -> list[str]:
    """Names as they stand in cleaned texts, empty and repeated ones left out."""
    cleaned = (re.sub(r"[^a-z]", " ", re.sub(r"[^a-zA-Z\s]", " ", name).lower()).strip() for name in names)
    return list(dict.fromkeys(name for name in cleaned if name))


def _place_inline(text_cols, names: list[str]) -> Column:
    """Title of the best name in the texts, found in one pass per raw text.

    The pattern reads the raw text as its cleaned form would be read: letter case does not
    count, a blank inside a name stands for any one character that cleaning turns into a
    blank, and a name ends where the ASCII letters end.  So the text need not be rewritten
    first.  At each word start the look-ahead keeps the first listed name that fits, hence
    names that overlap are all seen; the smallest list position over all hits wins.
    """
    blank = r"[^a-zA-Z\t\n\x0B\f\r]"
    # Grouped by first letter, each group in list order: names that fit at one place share it.
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(name[0], []).append("".join(blank if c == " " else re.escape(c) for c in name[1:]))
    listed = "|".join(f"{re.escape(first)}(?:{'|'.join(rests)})(?![a-z])" for first, rests in groups.items())
    pattern = rf"(?i)(?<![a-z])(?=[{''.join(map(re.escape, groups))}])(?=({listed}))"
    found = F.concat(*[F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(pattern), F.lit(1)) for c in text_cols])
    hits = F.transform(F.array_distinct(found), clean_text)
    order = F.array(*[F.lit(n) for n in names])
    best = F.array_min(F.transform(hits, lambda h: F.array_position(order, h)))
    titles = F.array(*[F.lit(n.title()) for n in names])
    return F.get(titles, (best - 1).cast("int"))


def geo_parse(df: DataFrame, text_cols, gazetteer=None, out: str = PLACE, default: str = "unknown",
              strategy: str | None = None, **join_options) -> DataFrame:
    """Detect the first listed place named as whole words in any of the texts.

    ``gazetteer`` is an ordered list of names, or a table ``(priority, name)``.  Names are cleaned as
    texts are, so "Gunung-Anyar" stands for "gunung anyar", whatever the plan.  A list is one regular
    expression without a shuffle (works on streams too), however long; a table goes through a join on
    word n-grams, see :func:`geo_parse_join`.  ``strategy`` ("inline", "case" or "join") picks for a list.
    """
    if isinstance(gazetteer, DataFrame):
        if strategy not in (None, "join"):
            raise ValueError(f"the {strategy} plan needs a list of names")
        return geo_parse_join(df, text_cols, gazetteer, out, default, **join_options)
    names = _cleaned(fixed.DISTRICTS if gazetteer is None else gazetteer)
    if not names:
        return df.withColumn(out, F.lit(default))
    if strategy == "join":
        table = df.sparkSession.createDataFrame(list(enumerate(names)), "priority long, name string")
        return geo_parse_join(df, text_cols, table, out, default, **join_options)
    if strategy == "case":
        expr = F
        texts = [clean_text(c) for c in text_cols]
        for name in names:
            hit = F.lit(False)
            for text in texts:
                hit = hit | text.rlike(rf"\b{re.escape(name)}\b")
            expr = expr.when(hit, F.lit(name.title()))
        return df.withColumn(out, expr.otherwise(F.lit(default)))
    return df.withColumn(out, F.coalesce(_place_inline(text_cols, names), F.lit(default)))


def name_trie(gazetteer: DataFrame) -> DataFrame:
    """The names' word prefixes as edges: ``(prefix, priority, deeper, words)``.

    ``priority`` is that of the name the prefix is, or NULL; ``deeper`` is the largest number of words of a name that
    starts with it.  Names are cleaned as texts are; of equal names the least priority counts.
    """
    cleaned = F.trim(F.translate(F.coalesce(clean_text("name"), F.lit("")), "\t\n\x0b\f\r", "     "))
    names = (gazetteer.select(cleaned.alias("name"), "priority").filter("name <> ''")
             .groupBy("name").agg(F.min("priority").alias("priority")).withColumn("parts", F.split("name", " ")))
    size = F.size("parts")
    edges = names.select("priority", "parts", size.alias("size"), F.explode(F.sequence(F.lit(1), size)).alias("words"))
    return (edges.select(F.array_join(F.slice("parts", F.lit(1), F.col("words")), " ").alias("prefix"), "words", "size",
                         F.when(F.col("words") == F.col("size"), F.col("priority")).alias("priority"))
            .groupBy("prefix", "words").agg(F.min("priority").alias("priority"), F.max("size").alias("deeper")))


def geo_parse_join(df: DataFrame, text_cols, gazetteer: DataFrame, out: str = PLACE,
                   default: str = "unknown", salts: int = 1, id_col: str | None = None) -> DataFrame:
    """Geo-parsing for a gazetteer of any size: a trie of name words, walked level by level.

    Every word of the texts is a row, with as many of the words after it as the longest name has; a join keeps those that
    start a name.  Each further level is one join on the prefix read so far; a row that has left the trie meets
    nothing more.  The least priority per text wins.  Rows travel with ``id_col`` (unique and not NULL) or else two hashes
    of their texts.  The sizes decide how the joins are done: a small trie is broadcast, a large one is shuffled by
    prefix, where AQE splits the rows of a frequent first word; ``salts`` above 1 spread them beforehand.
    """
    from ..sources.writers import overwrite, scratch_dir

    # As a table, so that the optimizer knows its size.
    path = scratch_dir(gazetteer.sparkSession, "trie")
    overwrite(name_trie(gazetteer), path)
    trie = gazetteer.sparkSession.read.parquet(path)
    max_words = trie.agg(F.max("words")).first()[0]
    if not max_words:
        return df.withColumn(out, F.lit(default))
    texts = [F.col(c).cast("string") for c in text_cols]
    keys = {"_t1": F.xxhash64(*texts), "_t2": F.xxhash64(F.lit("second"), *texts)} if id_col is None else {"_t1": F.col(id_col)}
    # A line break separates words but never joins a two-word name: it counts as two blanks.
    split = F.array(*[F.split(F.regexp_replace(F.coalesce(clean_text(c), F.lit("")), r"[\t\n\x0B\f\r]", "  "), " ") for c in text_cols])
    lists = df.select(*[k.alias(n) for n, k in keys.items()], F.explode(split).alias("_words"))
    tails = F.transform(F.sequence(F.lit(1), F.size("_words")), lambda i: F.slice("_words", i, F.lit(max_words)))
    words = (lists.select(*keys, F.posexplode(tails).alias("_at", "_rest"))
             .withColumn("_prefix", F.get("_rest", F.lit(0))).filter("_prefix <> ''"))
    hit = F.when(F.col("priority").isNotNull(), F.struct("priority", F.col("prefix").alias("name")))
    first = trie.filter("words = 1").select(F.col("prefix").alias("_prefix"), hit.alias("_best"), F.col("deeper").alias("_deeper"))
    on = ["_prefix"]
    if salts > 1:
        words = words.withColumn("_salt", F.pmod(F.col("_at"), F.lit(salts)))
        first, on = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["_prefix", "_salt"]
    walk = words.join(first, on).select(*keys, "_best", "_prefix", "_deeper", "_rest")
    for level in range(2, max_words + 1):
        edges = trie.filter(F.col("words") == level).select(
            F.col("prefix").alias("_next"), hit.alias("_hit"), F.col("deeper").alias("_deep"))
        goes_on = (F.col("_deeper") >= level) & (F.size("_rest") >= level)
        following = F.when(goes_on, F.concat("_prefix", F.lit(" "), F.get("_rest", F.lit(level - 1))))
        walk = walk.withColumn("_next", following).join(edges, "_next", "left").select(
            *keys, F.least("_best", "_hit").alias("_best"), F.col("_next").alias("_prefix"),
            F.coalesce("_deep", F.lit(0)).alias("_deeper"), "_rest").filter(F.col("_best").isNotNull() | (F.col("_deeper") > level))
    best = walk.filter("_best IS NOT NULL").groupBy(*keys).agg(F.min("_best").alias("_found")).select(*keys, F.col("_found.name").alias("_name"))
    joined = df.withColumns(keys).join(best, list(keys), "left")
    return joined.withColumn(out, F.coalesce(F.initcap("_name"), F.lit(default))).drop("_name", *keys)


# --- map points ----------------------------------------------------------------------

def district_table(spark, figures=None) -> DataFrame:
    """Dimension ``(place_key, lon, lat, area_km2, density)`` from a small figures map."""
    rows = [(k, *v) for k, v in (fixed.DISTRICT_FIGURES if figures is None else figures).items()]
    return literal_dimension(spark, rows, ["place_key", "lon", "lat", "area_km2", "density"])


def enrich_place(df: DataFrame, dimension: DataFrame, key: str, aliases=None) -> DataFrame:
    """Left join of the district figures on the normalised, alias-resolved key."""
    joined = df.withColumn("place_key", resolve_alias(normalize_key(key), aliases))
    return joined.join(dimension, "place_key", "left")


def jitter(df: DataFrame, index: str, lon: str = "lon", lat: str = "lat",
           spread: float = fixed.JITTER_SPREAD, centre=fixed.DEFAULT_CENTRE,
           out_lon: str = "point_lon", out_lat: str = "point_lat") -> DataFrame:
    """Move each point by a fixed amount derived from its index; no place gives the centre."""
    def moved(wave, base, fallback):
        x = wave(F.col(index) + 1) * 10000
        return F.coalesce(F.col(base), F.lit(fallback)) + (x - F.floor(x) - 0.5) * spread

    return df.withColumns({out_lon: moved(F.cos, lon, centre[0]), out_lat: moved(F.sin, lat, centre[1])})


def recency_index(df: DataFrame, ts: str, key: str, out: str = "index") -> DataFrame:
    """0-based position in order of recency, undated rows last."""
    return number_rows(df, [F.col(ts).desc_nulls_last(), F.col(key).asc()], out)


def in_box(lon, lat, box=fixed.BBOX) -> Column:
    return F.col(lat).between(box["lat_min"], box["lat_max"]) & F.col(lon).between(box["lon_min"], box["lon_max"])


def choose_point(df: DataFrame, cache: DataFrame, id_col: str, box=fixed.BBOX, lon: str = "point_lon",
                 lat: str = "point_lat") -> DataFrame:
    """Geocoded point of the cache ``(id, geo_lon, geo_lat)`` if inside the box, else the jittered one."""
    joined = df.join(cache, id_col, "left")
    usable = F.coalesce(in_box("geo_lon", "geo_lat", box), F.lit(False))
    return joined.withColumns({
        lon: F.when(usable, F.col("geo_lon")).otherwise(F.col(lon)),
        lat: F.when(usable, F.col("geo_lat")).otherwise(F.col(lat)),
        "from_cache": usable,
    }).drop("geo_lon", "geo_lat")


def point_features(df: DataFrame, lon: str, lat: str, properties) -> DataFrame:
    """One GeoJSON point feature per row, as text."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


# --- news choropleth -----------------------------------------------------------------

def label_ratio(news: DataFrame, key: str, label: str, bad: str, good: str) -> DataFrame:
    """Bad and good counts per key and the share of bad ones in percent (NULL if none)."""
    counts = news.groupBy(key).agg(F.count_if(F.col(label) == bad).alias("bad_count"),
                                   F.count_if(F.col(label) == good).alias("good_count"))
    total = F.col("bad_count") + F.col("good_count")
    return counts.withColumns({"total_count": total,
                               "news_score": F.try_divide(F.col("bad_count"), total) * 100})


def choropleth(places: DataFrame, news: DataFrame, place: str, news_place: str, label: str,
               bad: str, good: str, steps=fixed.COLOUR_STEPS) -> DataFrame:
    """Every place with its news ratio and colour step; places without news have NULL."""
    ratios = label_ratio(news.withColumn("place_key", normalize_key(news_place)), "place_key", label, bad, good)
    joined = (places.withColumn("place_key", normalize_key(place)).join(ratios, "place_key", "left")
              .fillna({"bad_count": 0, "good_count": 0, "total_count": 0}))
    return joined.withColumn("news_step", band("news_score", steps))


# --- boundary assembly ---------------------------------------------------------------

def stitch_rings(ways: DataFrame, tolerance: float = 1e-7, partitions: int | None = None) -> DataFrame:
    """Ways ``(relation_id, way_no, points array<struct<x, y>>)`` to closed rings.

    Only the two end points of each way travel to the linking step, which reads the
    relations of a partition one after the other; the points are joined back afterwards.
    A relation is linked as a whole, since each choice depends on the ways used so far;
    boundary relations have some thousand ways at most, five numbers each.
    Result: one row per ring with ``points`` (closed by force if needed) and whether the
    ways closed it themselves.
    """
    partitions = partitions or int(ways.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = ways.filter(F.size("points") > 0)
    first, last = F.get("points", F.lit(0)), F.element_at("points", -1)
    ends = ways.select("relation_id", "way_no", first.x.alias("x0"), first.y.alias("y0"),
                       last.x.alias("x1"), last.y.alias("y1"))
    ordered = ends.repartition(partitions, "relation_id").sortWithinPartitions("relation_id", "way_no")
    links = ordered.mapInPandas(lambda batches: link_partition(batches, tolerance), LINKS)
    placed = links.join(ways, ["relation_id", "way_no"])
    oriented = F.when(F.col("flipped"), F.reverse("points")).otherwise(F.col("points"))
    # Neighbouring ways share a point: the way that joined the ring later leaves it out.
    start = F.when(F.col("side") == 1, 2).otherwise(1)
    tail = F.slice(oriented, start, F.size("points") - F.abs("side").cast("int"))
    rings = placed.groupBy("relation_id", "ring").agg(
        F.bool_and("closed").alias("closed"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", tail.alias("points")))),
                              lambda s: s.points)).alias("points"))
    start = F.get("points", F.lit(0))
    return rings.withColumn("points", F.when(F.col("closed"), F.col("points"))
                            .otherwise(F.concat("points", F.array(start))))


def boundary_features(rings: DataFrame, relations: DataFrame) -> DataFrame:
    """One GeoJSON feature per relation: Polygon for one ring, else MultiPolygon.

    ``relations``: relation_id, name, admin_level.
    """
    ring = F.transform("points", lambda p: F.array(p.x, p.y))
    grouped = rings.select("relation_id", "ring", ring.alias("ring_points")).groupBy("relation_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ring", "ring_points"))), lambda r: r.ring_points).alias("r"))
    joined = relations.join(grouped, "relation_id")
    properties = F.struct("name", F.col("name").alias("kecamatan"), F.col("relation_id").alias("id"), "admin_level")

    def feature(kind: str, coordinates: Column) -> Column:
        return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"),
                                  F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))

    single = feature("Polygon", F.col("r"))
    multi = feature("MultiPolygon", F.transform("r", lambda x: F.array(x)))
    return joined.select("relation_id", F.when(F.size("r") == 1, single).otherwise(multi).alias("feature"))


def outer_ways(elements: DataFrame) -> DataFrame:
    """Outer ways of relation elements ``(id, type, members[type, role, geometry[lat, lon]])``."""
    members = (elements.filter(F.col("type") == "relation")
               .select(F.col("id").alias("relation_id"), F.posexplode("members").alias("way_no", "m")))
    return (members.filter((F.col("m.role") == "outer") & (F.col("m.type") == "way"))
            .select("relation_id", F.col("way_no").cast("long").alias("way_no"),
                    F.transform("m.geometry", lambda p: F.struct(p.lon.alias("x"), p.lat.alias("y"))).alias("points"))
            .filter(F.size("points") > 0))
