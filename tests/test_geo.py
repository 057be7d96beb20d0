import json
import random

import pytest
from pyspark.sql import functions as F

from wardrisk.functions import fixed
from wardrisk.operators import geo

TEXTS = [
    ("1", "gunung-anyar dan Kenjeran", None, "Gunung Anyar"),
    ("2", "x gunung  anyar", "di wiyung", "Wiyung"),
    ("3", "wiyungan", None, "unknown"),
    ("4", "Gunung\nAnyar", "", "unknown"),
    ("5", "tandes asemrowo", "", "Asemrowo"),
    ("6", "KARANG1PILANG", "tandes", "Karang Pilang"),
    ("7", "pakalé", "bulak_bulak", "Bulak"),
    ("8", None, None, "unknown"),
    ("9", "dukuh\U0001F600pakis", "", "Dukuh Pakis"),
    ("10", "dukuh éé pakis", "", "unknown"),
]


@pytest.mark.parametrize("strategy", ["case", "inline", "join"])
def test_geo_parse_edges(spark, strategy):
    df = spark.createDataFrame([t[:3] for t in TEXTS], "id string, judul string, deskripsi_mentah string")
    out = geo.geo_parse(df, ["deskripsi_mentah", "judul"], strategy=strategy)
    assert {r.id: r.kecamatan_terdeteksi for r in out.collect()} == {t[0]: t[3] for t in TEXTS}


def test_geo_parse_plans_agree_on_overlapping_names(spark):
    names = ["b c", "a b", "c", "a", "b c d", "d e f", "f"]
    draw = random.Random(7)
    texts = [(str(i), "".join(draw.choice("abcdefAB -\n1") for _ in range(draw.randrange(40)))) for i in range(400)]
    df = spark.createDataFrame(texts, "id string, t string")
    results = [sorted((r.id, r.p) for r in geo.geo_parse(df, ["t"], names, "p", strategy=s).collect())
               for s in ("case", "inline", "join")]
    salted = geo.geo_parse(df, ["t"], names, "p", strategy="join", salts=3)
    results.append(sorted((r.id, r.p) for r in salted.collect()))
    assert results[0] == results[1] == results[2] == results[3]
    assert len({p for _, p in results[0]}) > 5


def test_large_gazetteer_as_table(spark):
    gazetteer = spark.range(5000).select(F.col("id").alias("priority"), F.concat(F.lit("kampung x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("name"))
    df = spark.createDataFrame([(1, "ke Kampung xbcd dan kampung xb"), (2, "tidak")], "id long, t string")
    out = geo.geo_parse(df, ["t"], gazetteer, "p")
    assert {r.id: r.p for r in out.collect()} == {1: "Kampung Xb", 2: "unknown"}


@pytest.mark.parametrize("strategy", ["case", "inline", "join"])
def test_names_are_cleaned_like_texts(spark, strategy):
    df = spark.createDataFrame([(1, "rapat di Gunung-Anyar dan Tandes"), (2, "tandes, gunung anyar"), (3, "Tandes"), (3, "tandes"), (4, None)], "id int, t string")
    for names in (["gunung-anyar", "tandes"], ["Gunung Anyar", "TANDES", "", "-"]):
        out = geo.geo_parse(df, ["t"], names, "p", strategy=strategy)
        assert sorted((r.id, r.p) for r in out.collect()) == [
            (1, "Gunung Anyar"), (2, "Gunung Anyar"), (3, "Tandes"), (3, "Tandes"), (4, "unknown")]


def test_a_long_list_is_still_one_pattern(spark):
    names = ["tandes"] + ["kampung " + "".join(chr(97 + int(d)) for d in str(i)) for i in range(700)]
    df = spark.createDataFrame([("di Kampung FGJ",), ("Kampung fgj dekat Tandes",)], "t string")
    assert [r.p for r in geo.geo_parse(df, ["t"], names, "p").collect()] == ["Kampung Fgj" if "kampung fgj" in names else "unknown", "Tandes"]


def test_jitter_and_default_centre(spark):
    import math

    df = spark.createDataFrame([(0, 112.6789, -7.2605), (5, None, None)], "index long, lon double, lat double")
    got = {r["index"]: (r.point_lon, r.point_lat) for r in geo.jitter(df, "index").collect()}
    for i, lon, lat in ((0, 112.6789, -7.2605), (5, *fixed.DEFAULT_CENTRE)):
        x, y = math.cos(i + 1) * 10000, math.sin(i + 1) * 10000
        assert got[i][0] == pytest.approx(lon + (x - math.floor(x) - 0.5) * 0.012, abs=1e-9)
        assert got[i][1] == pytest.approx(lat + (y - math.floor(y) - 0.5) * 0.012, abs=1e-9)


def test_district_figures_and_alias(spark):
    places = spark.createDataFrame([("Kecamatan Aseminrowo",), ("Tenggilis",), ("Darmo",)], "p string")
    got = {r.p: r.area_km2 for r in geo.enrich_place(places, geo.district_table(spark), "p").collect()}
    assert got == {"Kecamatan Aseminrowo": 15.40, "Tenggilis": 5.52, "Darmo": None}
    assert geo.district_table(spark).count() == len(fixed.DISTRICTS) == 31


def test_choose_point_and_features(spark):
    df = spark.createDataFrame([(1, 112.7, -7.2), (2, 112.7, -7.2), (3, 112.7, -7.2)], "id int, point_lon double, point_lat double")
    cache = spark.createDataFrame([(1, 112.6, -7.3), (2, 110.0, -7.3)], "id int, geo_lon double, geo_lat double")
    got = {r.id: (r.point_lon, r.from_cache) for r in geo.choose_point(df, cache, "id").collect()}
    assert got == {1: (112.6, True), 2: (112.7, False), 3: (112.7, False)}
    feature = json.loads(geo.point_features(df, "point_lon", "point_lat", [F.col("id"), F.lit(None).cast("string").alias("d")]).first().feature)
    assert feature == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [112.7, -7.2]}, "properties": {"id": 1, "d": None}}


def test_choropleth(spark):
    places = spark.createDataFrame([("Tandes",), ("Pakal",), ("Bulak",)], "name string")
    news = spark.createDataFrame([("tandes", "K"), ("Kecamatan Tandes", "S"), ("Pakal", "Other")], "p string, c string")
    got = {r.name: (r.bad_count, r.total_count, r.news_score, r.news_step) for r in geo.choropleth(places, news, "name", "p", "c", "K", "S").collect()}
    assert got == {"Tandes": (1, 2, 50.0, "2"), "Pakal": (0, 0, None, None), "Bulak": (0, 0, None, None)}


def ways(spark, data):
    rows = [(rel, no, [(float(x), float(y)) for x, y in pts]) for rel, no, pts in data]
    return spark.createDataFrame(rows, "relation_id long, way_no long, points array<struct<x: double, y: double>>")


def test_stitch_rings(spark):
    data = [
        # one ring: later ways turned round, one joined at the start
        (1, 0, [(0, 0), (1, 0)]), (1, 1, [(0, 1), (0, 0)]), (1, 2, [(1, 1), (1, 0)]), (1, 3, [(1, 1), (0.5, 1), (0, 1)]),
        # two rings, a closed way on its own, and an open one closed by force
        (2, 0, [(0, 0), (1, 0), (0, 1), (0, 0)]), (2, 1, [(5, 5), (6, 5)]), (2, 2, [(6, 5), (6, 6)]),
    ]
    rings = {(r.relation_id, r.ring): r for r in geo.stitch_rings(ways(spark, data)).collect()}
    assert set(rings) == {(1, 0), (2, 0), (2, 1)}
    one = [tuple(p) for p in rings[1, 0].points]
    assert rings[1, 0].closed and one == [(0, 1), (0, 0), (1, 0), (1, 1), (0.5, 1), (0, 1)]
    assert rings[2, 0].closed and len(rings[2, 0].points) == 4
    assert not rings[2, 1].closed and [tuple(p) for p in rings[2, 1].points] == [(5, 5), (6, 5), (6, 6), (5, 5)]
    relations = spark.createDataFrame([(1, "A", "6"), (2, "B", "6")], "relation_id long, name string, admin_level string")
    features = {r.relation_id: json.loads(r.feature) for r in geo.boundary_features(geo.stitch_rings(ways(spark, data)), relations).collect()}
    assert features[1]["geometry"]["type"] == "Polygon" and len(features[1]["geometry"]["coordinates"][0]) == 6
    assert features[2]["geometry"]["type"] == "MultiPolygon" and len(features[2]["geometry"]["coordinates"]) == 2
    assert features[1]["properties"] == {"name": "A", "kecamatan": "A", "id": 1, "admin_level": "6"}


def brute_rings(parts, eps=1e-7):
    """Rings by trying every free way in list order until nothing fits."""
    def same(p, q):
        return abs(p[0] - q[0]) < eps and abs(p[1] - q[1]) < eps
    free, rings = [list(p) for p in parts], []
    while free:
        ring, grown = free.pop(0), True
        while grown and not same(ring[0], ring[-1]):
            grown = False
            for k, way in enumerate(free):
                joined = None
                if same(ring[-1], way[0]):
                    joined = ring + way[1:]
                elif same(ring[-1], way[-1]):
                    joined = ring + way[::-1][1:]
                elif same(ring[0], way[-1]):
                    joined = way[:-1] + ring
                elif same(ring[0], way[0]):
                    joined = way[::-1][:-1] + ring
                if joined:
                    ring, grown = joined, True
                    del free[k]
                    break
        rings.append(ring if same(ring[0], ring[-1]) else ring + [ring[0]])
    return rings


def test_stitch_against_brute_force(spark):
    draw = random.Random(3)
    data = []
    for rel in range(40):
        nodes = [(float(x), float(y)) for x in range(3) for y in range(3)]
        for no in range(draw.randrange(1, 12)):
            a, b = draw.sample(nodes, 2)
            data.append((rel, no, [a, (draw.random(), draw.random()), b]))
    got: dict = {}
    for r in geo.stitch_rings(ways(spark, data)).orderBy("relation_id", "ring").collect():
        got.setdefault(r.relation_id, []).append([tuple(p) for p in r.points])
    for rel in range(40):
        assert got[rel] == brute_rings([p for r, _, p in data if r == rel]), rel


def test_outer_ways(spark):
    text = json.dumps({"type": "relation", "id": 7, "members": [
        {"type": "way", "role": "outer", "geometry": [{"lat": 1.0, "lon": 2.0}, {"lat": 3.0, "lon": 4.0}]},
        {"type": "way", "role": "inner", "geometry": [{"lat": 1.0, "lon": 2.0}]}, {"type": "node", "role": "outer"}]})
    schema = ("id long, type string, members array<struct<type: string, role: string, geometry: array<struct<lat: double, lon: double>>>>")
    elements = spark.createDataFrame([(text,)], "v string").select(F.from_json("v", schema).alias("d")).select("d.*")
    row = geo.outer_ways(elements).collect()
    assert [(r.relation_id, r.way_no, [tuple(p) for p in r.points]) for r in row] == [(7, 0, [(2.0, 1.0), (4.0, 3.0)])]


def test_recency_index_numbers_all_rows(spark):
    df = spark.range(5000).select("id", (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 977)).alias("ts"))
    got = geo.recency_index(df, "ts", "id").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(5000))
    assert [r.id for r in got] == sorted(range(5000), key=lambda i: (-(i % 977), i))


def test_trie_of_many_names(spark):
    """Names that start alike, of one to five words, with equal priorities and blanks between words, against one pattern each."""
    draw = random.Random(11)
    names = sorted({" ".join(draw.choice("abcdefgh") for _ in range(draw.choice([2, 2, 3, 3, 4, 5]))) for _ in range(90)} | {"g"})
    draw.shuffle(names)
    texts = [(i, "".join(draw.choice("abcdefhABC   -\n.") for _ in range(draw.randrange(60))), None if i % 7 else "d g") for i in range(300)]
    df = spark.createDataFrame(texts + [(900, None, None)], "id int, t string, u string")
    table = spark.createDataFrame(list(enumerate(names)), "priority long, name string")
    want = {r.id: r.p for r in geo.geo_parse(df, ["t", "u"], names, "p", strategy="case").collect()}
    for options in ({}, {"id_col": "id"}, {"salts": 4}):
        assert {r.id: r.p for r in geo.geo_parse(df, ["t", "u"], table, "p", **options).collect()} == want
    assert {r.p for r in geo.geo_parse(df, ["t"], table.limit(0), "p").collect()} == {"unknown"}
    assert len(set(want.values())) > 8, sorted(set(want.values()))
