"""Column expressions, with the edge values each of them has to survive under ANSI mode."""

import datetime as dt

from pyspark.sql import functions as F

from wardrisk import functions as W
from wardrisk.functions import fixed, numeric


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items()) or "_x int"
    df = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return df.select(expr.alias("v")).first().v


def test_standardize_name_keeps_inner_spaces(spark):
    assert one(spark, W.standardize_name("x"), x="  KARANG  pilang ") == "Karang  Pilang"
    assert one(spark, W.standardize_name("x"), x=None) is None


def test_clean_text_one_blank_per_character(spark):
    assert one(spark, W.clean_text("x"), x="Gunung-Anyar: é12 Ok\n") == "gunung anyar      ok\n"


def test_document_text_skips_null(spark):
    assert one(spark, W.document_text("a", "b"), a="t", b=None) == "t"


def test_normalize_key_first_hit_only(spark):
    cases = {"Kecamatan Tandes": "tandes", "KEC. Pakal ": "pakal", "kecamatan kecamatan x": "kecamatan x",
             "a kec. b kec. c": "a  b kec. c", "kecXtandes": "kecxtandes", None: "", "": ""}
    for text, want in cases.items():
        assert one(spark, W.normalize_key("x"), x=text) == want


def test_alias(spark):
    assert one(spark, W.resolve_alias("x"), x="aseminrowo") == "asemrowo"
    assert one(spark, W.resolve_alias("x"), x="tandes") == "tandes"
    assert one(spark, W.resolve_alias("x", {}), x="tenggilis") == "tenggilis"


def test_html_to_text(spark):
    html = ("<!DOCTYPE html><p>A<b>b</b>&amp;lt; &#233;&#x1F600;&nbsp;&euro;&bogus; x&y</p><script>var t='</p>';</script>"
            "<!-- <i>c</i> --><style>p{}</style><a title='x>y'>z</a> 1 < 2\n\t end")
    assert one(spark, W.html_to_text("x"), x=html) == "A b &lt; é😀 €&bogus; x&y z 1 < 2 end"
    assert one(spark, W.html_to_text("x"), x="") == ""
    assert one(spark, W.html_to_text("x"), x=None) == ""
    assert one(spark, W.html_to_text("x"), x="&#0; &#99999999; &#x110000; &#xD800; &#00000000065;") == "\ufffd \ufffd \ufffd \ufffd A"
    assert one(spark, W.html_to_text("x"), x="&#128; &#x92; &#129;|&check;&lpar; &hellip x&nosuch; &amp") == "€ ’ \x81|✓( … x&nosuch; &"


def test_html_that_is_not_well_formed(spark):
    for html, text in (("<p title=it's>hello</p>", "hello"), ("a<script>var x = 1; </scrip>", "a"), ("a<!-- b <i>c</i>", "a"),
                       ("a<style>p{}", "a"), ("<a b = 'x>y' c=\"d>e\" f=g>h</a>", "h"),
                       ("<br/>x<hr/ >y", "x y"), ("<script>1</script>a<script>2</script >b", "a b"), ("1 < 2 > 3", "1 < 2 > 3")):
        assert one(spark, W.html_to_text("x"), x=html) == text, html


def test_html_long_attribute_does_not_overflow(spark):
    html = "<a href='" + "x" * 200_000 + "' " + "b=\"1\" " * 20_000 + ">ok</a>"
    assert one(spark, W.html_to_text("x"), x=html) == "ok"


def test_stable_id(spark):
    import hashlib

    link = "https://example.org/ä"
    assert one(spark, W.stable_id("x"), x=link) == hashlib.sha256(link.encode()).hexdigest()[:16]


def test_publisher(spark):
    def source(s, t):
        return one(spark, W.publisher("s", "t"), s=s, t=t)
    assert source("detik", "a - b") == "detik"
    assert source(None, "a - b - kompas.com ") == "kompas.com"
    assert source(None, "a - - b") == "b"
    assert source(None, "a-b") == "Unknown"
    assert source(None, None) == "Unknown"


def test_published_at(spark):
    now = F.lit("2025-01-02 03:04:05").cast("timestamp")

    def at(x):
        return one(spark, W.published_at("x", now), x=x)
    assert at("Mon, 23 Jun 2025 12:00:00 GMT") == "2025-06-23T12:00:00"
    assert at("23 Jun 2025 19:00:00 +0700") == "2025-06-23T12:00:00"
    assert at("2025-06-23T12:00:00") == "2025-06-23T12:00:00"
    assert at("2025-06-23T12:00:00+07:00") == at("2025-06-23T05:00:00Z") == "2025-06-23T05:00:00"
    assert at("kemarin") == "kemarin"
    # No seconds, two digits of the year, named zones, long names, other order marks.
    assert at("Mon, 23 Jun 2025 08:00 EDT") == at("23 Jun 25 04:00:00 PST") == "2025-06-23T12:00:00"
    assert at("Monday, 23-June-2025 12:00:00 UTC") == at("23 jun 2025 12:00:00") == at("23 Jun 2025 14:00:00 +02:00 (CEST)") == "2025-06-23T12:00:00"
    assert at("Sat, 1 Jan 99 0:05 GMT") == "1999-01-01T00:05:00"
    assert at("23 Jun 2025 12:00:00 XYZ") == "23 Jun 2025 12:00:00 XYZ"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        assert at("23 Jun 2025 19:00:00 +0700") == at("2025-06-23T12:00:00") == "2025-06-23T12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert at(None) == at("") == "2025-01-02T03:04:05"


def test_to_ts_and_iso(spark):
    assert one(spark, W.to_ts(F.col("x")), x="2025-06-23T12:00:00") == dt.datetime(2025, 6, 23, 12)
    assert one(spark, W.to_ts(F.col("x")), x="Mon, 23 Jun 2025 12:00:00 GMT") is None
    assert one(spark, W.iso_text(W.to_ts(F.col("x"))), x="nope") is None


def test_link_predicates(spark):
    assert one(spark, W.is_listing_page("x"), x=None) is True
    assert one(spark, W.is_listing_page("x"), x="https://e.org/tag/y") is True
    assert one(spark, W.is_listing_page("x"), x="https://e.org/news/y") is False
    assert one(spark, W.is_article_link("x"), x="") is False
    assert one(spark, W.is_article_link("x"), x=None) is False
    assert one(spark, W.is_article_link("x"), x="https://www.google.com/search?q=1") is False
    assert one(spark, W.is_article_link("x"), x="https://e.org/a") is True


def test_decode_redirect(spark):
    import base64

    def packed(raw):
        return "https://news.google.com/rss/articles/" + base64.urlsafe_b64encode(raw).decode().rstrip("=") + "?oc=5"
    target = "https://example.org/a?b=1~c"
    for pad in range(4):
        link = packed(b"\x08\x13\"" + b"\xff" * pad + target.encode() + b"\xd2\x01\x00")
        assert one(spark, W.decode_redirect("x"), x=link) == target
    nothing = packed(b"no link here")
    broken = "https://news.google.com/rss/articles/a*b"
    five = "https://news.google.com/articles/abcde"
    for same in (nothing, broken, five, "https://e.org/articles/aHR0cHM6Ly9h", None):
        assert one(spark, W.decode_redirect("x"), x=same) == same


def test_search_phrase_and_url(spark):
    title = "Polisi tangkap pelaku di Tandes, akibat (mabuk) oleh warga kampung sebelah"
    assert one(spark, W.search_phrase("x"), x=title) == "Polisi tangkap pelaku Tandes (mabuk) Surabaya"
    assert one(spark, W.search_url("x"), x="Kota's jalan* raya~ 100%") == (
        "https://news.google.com/search?q=Kota's%20jalan*%20raya~%20100%25%20Surabaya&hl=id&gl=ID&ceid=ID:id")


def test_place_phrase_cascade(spark):
    def place(a, b=None):
        return one(spark, W.place_phrase("a", "b"), a=a, b=b)
    assert place("Tabrakan di Jalan Raya Darmo Kecamatan Wonokromo") == "jalan raya darmo, Surabaya"
    assert place("Di jl. di sana", "kebakaran Pasar  Turi baru sekali pagi") == "pasar turi baru sekali, Surabaya"
    assert place("warga kel. Ketintang resah") == "kel. ketintang resah, Surabaya"
    assert place("RSUD") is None
    assert place("tidak ada", None) is None
    assert place(None, None) is None


def test_rate_and_weights(spark):
    rate = numeric.per_capita(F.col("n"), F.col("d"), 100_000)
    assert one(spark, rate, n=1.0, d=115913.0) == 1 / 115913 * 100000
    assert one(spark, rate, n=1.0, d=0.0) is None
    assert abs(one(spark, W.weighted([("a", 0.7, False), ("b", 0.3, True)]), a=50.0, b=20.0) - 59) < 1e-12


def test_band_edges(spark):
    def level(bands, x):
        return one(spark, W.band(F.col("x"), bands), x=x)
    assert [level(fixed.RISK_LEVELS, x) for x in (80.0, 79.9, 60.0, 40.0, 39.9)] == ["EKSTRIM", "TINGGI", "TINGGI", "SEDANG", "RENDAH"]
    assert [level(fixed.COLOUR_STEPS, x) for x in (100.0, 80.0, 60.0, 40.0, 20.0, 19.9)] == ["4", "4", "3", "2", "1", "0"]
    assert [level(fixed.CRIME_ZONES, x).split()[0] for x in (80.1, 80.0, 20.0, 0.0)] == ["Ekstrim", "Tinggi", "Waspada", "Aman"]
    assert level(fixed.HEALTH_ZONES, 75.0).startswith("Tinggi") and level(fixed.HEALTH_ZONES, 75.1).startswith("Kritis")
    assert one(spark, W.band(F.col("x").cast("double"), fixed.RISK_LEVELS), x=None) is None


def test_fixed_text_and_change(spark):
    assert one(spark, W.fixed_text("x", 2), x=92.60395) == "92.60"
    assert one(spark, W.percent_change("a", "b"), a=3377.0, b=8759.0) == 159
    assert one(spark, W.percent_change("a", "b"), a=0.0, b=1.0) is None
