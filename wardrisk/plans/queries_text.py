"""Text queries: cleaning, geo-parsing, links, phrases, HTML and term weights."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import (clean_text, decode_redirect, document_text, html_to_text, is_listing_page,
                         normalize_key, place_phrase, published_at, publisher, resolve_alias,
                         search_phrase, search_url, stable_id, standardize_name)
from ..operators import geo, topics
from . import roles
from .queries_index import rounded
from .registry import query
from .roles import CLEAN_SQL, DOCUMENTS_SQL, PLACES


@query("text_clean", f"SELECT doc_id, {CLEAN_SQL.format('text')} AS cleaned FROM documents")
def text_clean(spark, sf_dir):
    return roles.text_table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned"))


@query("document_text", f"""
WITH {DOCUMENTS_SQL.strip()} SELECT doc_id, md5(concat_ws(' ', judul, deskripsi_mentah)) AS text_md5 FROM docs""")
def joined_text(spark, sf_dir):
    docs = roles.documents(spark, sf_dir)
    return docs.select("doc_id", F.md5(document_text("judul", "deskripsi_mentah")).alias("text_md5"))


def _place_sql() -> str:
    clean_title, clean_body = (CLEAN_SQL.format(c) for c in ("judul", "deskripsi_mentah"))
    cases = "\n".join(
        f"WHEN coalesce(regexp_matches(b, '\\b{p}\\b'), false) OR coalesce(regexp_matches(t, '\\b{p}\\b'), false) THEN '{p.title()}'"
        for p in PLACES)
    return f"""{DOCUMENTS_SQL.strip()},
cleaned AS (SELECT doc_id, lang, {clean_title} AS t, {clean_body} AS b FROM docs),
placed AS (SELECT doc_id, lang, CASE {cases} ELSE 'unknown' END AS kecamatan_terdeteksi FROM cleaned)"""


def placed_documents(spark, sf_dir, **options):
    return geo.geo_parse(roles.documents(spark, sf_dir), ["deskripsi_mentah", "judul"], PLACES, **options)


@query("geo_parse", f"WITH {_place_sql()} SELECT doc_id, kecamatan_terdeteksi FROM placed")
def geo_parse(spark, sf_dir):
    return placed_documents(spark, sf_dir).select("doc_id", "kecamatan_terdeteksi")


@query("geo_parse_join", f"WITH {_place_sql()} SELECT doc_id, kecamatan_terdeteksi FROM placed")
def geo_parse_join(spark, sf_dir):
    return placed_documents(spark, sf_dir, strategy="join", salts=1).select("doc_id", "kecamatan_terdeteksi")


@query("geo_parse_salted", f"WITH {_place_sql()} SELECT doc_id, kecamatan_terdeteksi FROM placed")
def geo_parse_salted(spark, sf_dir):
    """The gazetteer as a table that also has a name for every part, far more than a pattern should list.

    The digits of a part's key are spelled in letters, as cleaning would make blanks of them, so all names differ.
    """
    key = F.translate(F.col("p_partkey").cast("string"), "0123456789", "abcdefghij")
    parts = roles.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + len(PLACES)).cast("long").alias("priority"), F.concat(F.lit("Part-Nr "), key, F.lit("x")).alias("name"))
    spelled = [(i, name.upper().replace(" ", "-")) for i, name in enumerate(PLACES)]
    gazetteer = spark.createDataFrame(spelled, "priority long, name string").unionByName(parts)
    docs = roles.documents(spark, sf_dir)
    return geo.geo_parse(docs, ["deskripsi_mentah", "judul"], gazetteer).select("doc_id", "kecamatan_terdeteksi")


@query("geo_counts", f"""
WITH {_place_sql()} SELECT kecamatan_terdeteksi, count(*) AS n FROM placed WHERE kecamatan_terdeteksi <> 'unknown' GROUP BY ALL""")
def geo_counts(spark, sf_dir):
    from ..operators.clean import exclude_value
    from ..operators.index import count_per_key

    return count_per_key(exclude_value(placed_documents(spark, sf_dir), "kecamatan_terdeteksi"), "kecamatan_terdeteksi", "n")


@query("name_standard", """
SELECT p_partkey, trim(padded) AS name FROM (
  SELECT p_partkey, array_to_string(list_transform(string_split('  ' || upper(p_name) || '  of  ' || p_type || ' ', ' '),
         lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS padded FROM part)""")
def name_standard(spark, sf_dir):
    messy = F.concat(F.lit("  "), F.upper("p_name"), F.lit("  of  "), "p_type", F.lit(" "))
    return roles.table(spark, sf_dir, "part").select("p_partkey", standardize_name(messy).alias("name"))


@query("key_normalise", """
SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(spelled), 'kecamatan', ''), 'kec\\.', '')) AS key
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Kecamatan ' || n_name || ' kecamatan'
        WHEN 1 THEN 'KEC. ' || lower(n_name) ELSE ' ' || n_name || ' kec.' END AS spelled
      FROM customer JOIN nation ON n_nationkey = c_nationkey)""")
def key_normalise(spark, sf_dir):
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    kind = F.col("c_custkey") % 3
    spelled = (F.when(kind == 0, F.concat(F.lit("Kecamatan "), "n_name", F.lit(" kecamatan")))
               .when(kind == 1, F.concat(F.lit("KEC. "), F.lower("n_name")))
               .otherwise(F.concat(F.lit(" "), "n_name", F.lit(" kec."))))
    customers = roles.table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return customers.select("c_custkey", normalize_key(spelled).alias("key"))


ALIASES = {"nation 1": "nation_1", "n2": "nation_2"}


@query("alias_resolve", """
SELECT key, count(*) AS n FROM (
  SELECT CASE WHEN n_nationkey IN (1, 2) THEN 'nation_' || n_nationkey ELSE lower(n_name) END AS key
  FROM supplier JOIN nation ON n_nationkey = s_nationkey) GROUP BY ALL""")
def alias_resolve(spark, sf_dir):
    """Suppliers of two nations are spelled two ways; the alias map brings them together."""
    nation = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    odd = F.col("s_suppkey") % 2 == 1
    spelled = (F.when(odd & (F.col("s_nationkey") == 1), F.lit("Nation 1"))
               .when(odd & (F.col("s_nationkey") == 2), F.lit("N2")).otherwise(F.col("n_name")))
    keyed = roles.table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        resolve_alias(normalize_key(spelled), ALIASES).alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


HTML_SQL = r"""
trim(regexp_replace(replace(replace(replace(replace(
  regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[!?][^>]*>|</?[a-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>', ' ', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query("html_text", f"SELECT page_id, {HTML_SQL.strip()} AS plain FROM pages")
def html_text(spark, sf_dir):
    return roles.text_table(spark, sf_dir, "pages").select("page_id", html_to_text("html").alias("plain"))


@query("html_known_text", r"""
SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN '€ ' ELSE '' END || trim(regexp_replace(text, '\s+', ' ', 'g')) AS plain FROM documents""")
def html_known_text(spark, sf_dir):
    """Markup of many kinds around the text of each document; what comes back has to be that text."""
    text = F.col("text")
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(ref))
    named = text
    for char, ref in (("é", "&eacute;"), ("ñ", "&ntilde;"), ("ß", "&#223;"), ("ü", "&#xfc;"), ("$", "&dollar;")):
        named = F.replace(named, F.lit(char), F.lit(ref))
    kind = F.col("doc_id") % 6
    markup = (F.when(kind == 0, F.concat(F.lit("<p title=it's>"), text, F.lit("</p><br/>")))
              .when(kind == 1, F.concat(F.lit('<script>var t = "</p>";</script><a href=\'x>y\' b>'), text, F.lit("</a><!-- open <b>end</b>")))
              .when(kind == 2, F.concat(F.lit("<!DOCTYPE html><b>"), named, F.lit("</b><style>p{}")))
              .when(kind == 3, F.replace(text, F.lit("e"), F.lit("&#0000000101;")))
              .when(kind == 4, F.concat(F.lit("<style>a > b {}</style><!-- c --><i data-x=\"1 > 2\">"), text, F.lit("</i><script>open(")))
              .otherwise(F.concat(F.lit("&#128 <em>"), F.replace(text, F.lit(" "), F.lit("&#32;")), F.lit("</em>"))))
    return roles.text_table(spark, sf_dir, "documents").select("doc_id", html_to_text(markup).alias("plain"))


@query("stable_id", "SELECT page_id, substr(sha256(url), 1, 16) AS id FROM pages")
def stable_ids(spark, sf_dir):
    return roles.table(spark, sf_dir, "pages").select("page_id", stable_id("url").alias("id"))


@query("publisher", r"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Stated' WHEN 1 THEN 'Unknown' WHEN 2 THEN 'site ' || page_id
       ELSE regexp_extract(url, '^https?://([^/]+)', 1) END AS source FROM pages""")
def publishers(spark, sf_dir):
    kind = F.col("page_id") % 4
    title = (F.when(kind == 2, F.concat(F.lit("A - b - site "), F.col("page_id").cast("string"), F.lit(" ")))
             .when(kind == 3, F.concat(F.lit("Title - "), F.regexp_extract("url", r"^https?://([^/]+)", 1)))
             .otherwise(F.lit("No dash-here")))
    stated = F.when(kind == 0, F.lit("Stated"))
    return roles.table(spark, sf_dir, "pages").select("page_id", publisher(stated, title).alias("source"))


@query("published_at", """
SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'yesterday' WHEN event_id % 10 = 4 THEN '2024-01-31T00:00:00'
       WHEN event_id % 10 = 7 THEN strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') END AS published FROM events""")
def published(spark, sf_dir):
    """Dates as feed text of many shapes, as ISO text, as other text and missing."""
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    kind = F.col("event_id") % 10
    rfc = F.date_format(ts, "d MMM yyyy HH:mm:ss")

    def moved(hours: int, pattern: str = "d MMM yyyy HH:mm:ss"):
        return F.date_format(ts + F.expr(f"interval {hours} hours"), pattern)

    text = (F.when(kind == 0, F.concat(F.lit("Mon, "), rfc, F.lit(" GMT")))
            .when(kind == 1, F.concat(moved(7), F.lit(" +0700")))
            .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(kind == 3, F.lit("yesterday"))
            .when(kind == 5, F.concat(F.lit("Monday, "), moved(-5), F.lit(" EST")))
            .when(kind == 6, F.concat(moved(-7, "dd-MMM-yy HH:mm:ss"), F.lit(" PDT")))
            .when(kind == 7, F.concat(F.date_format(ts, "d MMM yyyy HH:mm"), F.lit(" Z")))
            .when(kind == 8, rfc)
            .when(kind == 9, F.concat(F.upper(moved(2, "d MMM yyyy H:mm:ss")), F.lit(" +02:00 (CEST)"))))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return roles.table(spark, sf_dir, "events").select("event_id", published_at(text, now).alias("published"))


@query("listing_pages", """
SELECT page_id, coalesce(contains(url, '/tag/') OR contains(url, '/search') OR contains(url, '/kategori/')
       OR contains(url, '/topic/'), true) AS listing
FROM (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url || '/tag/x' WHEN 1 THEN url || '/search?q=1'
        WHEN 2 THEN NULL ELSE url END AS url FROM pages)""")
def listing_pages(spark, sf_dir):
    kind = F.col("page_id") % 6
    link = (F.when(kind == 0, F.concat("url", F.lit("/tag/x"))).when(kind == 1, F.concat("url", F.lit("/search?q=1")))
            .when(kind != 2, F.col("url")))
    return roles.table(spark, sf_dir, "pages").select("page_id", is_listing_page(link).alias("listing"))


@query("redirect_decode", r"""
SELECT page_id, CASE WHEN page_id % 5 = 4 THEN 'https://news.google.com/rss/articles/%%%'
       WHEN page_id % 5 = 3 THEN url ELSE regexp_extract(url, '^[a-zA-Z0-9\-._~:/?#\[\]@!$&''()*+,;=%]+') END AS target
FROM pages""")
def redirect_decode(spark, sf_dir):
    """Page links packed the way redirect links are, some of them broken or plain."""
    kind = F.col("page_id") % 5
    packed = F.base64(F.concat(F.unhex(F.lit("08132259")), F.encode("url", "UTF-8"), F.unhex(F.lit("D20100"))))
    safe = F.rtrim(F.translate(F.regexp_replace(packed, r"\s", ""), "+/=", "-_"))
    link = (F.when(kind == 4, F.lit("https://news.google.com/rss/articles/%%%")).when(kind == 3, F.col("url"))
            .otherwise(F.concat(F.lit("https://news.google.com/rss/articles/"), safe, F.lit("?oc=5"))))
    return roles.table(spark, sf_dir, "pages").select("page_id", decode_redirect(link).alias("target"))


PHRASE_STOPWORDS = ["ment", "tion", "with", "that", "this", "from", "nicht"]


@query("search_phrase", f"""
WITH {DOCUMENTS_SQL.strip()}
SELECT doc_id, array_to_string(list_filter(string_split_regex(judul, '[\\s,]+'),
       lambda w: length(w) > 3 AND NOT list_contains({PHRASE_STOPWORDS!r}, lower(w)))[1:5], ' ') || ' Surabaya' AS phrase
FROM docs""")
def search_phrases(spark, sf_dir):
    return roles.documents(spark, sf_dir).select("doc_id", search_phrase("judul", stopwords=PHRASE_STOPWORDS).alias("phrase"))


@query("search_url", r"""
SELECT p_partkey, 'https://news.google.com/search?q=' || replace(replace(url_encode(phrase), '%28', '('), '%29', ')')
       || '&hl=id&gl=ID&ceid=ID:id' AS url
FROM (SELECT p_partkey, array_to_string(list_filter(string_split_regex(p_name || ' (100% "neu") & süß', '[\s,]+'),
        lambda w: length(w) > 3)[1:5], ' ') || ' Surabaya' AS phrase FROM part)""")
def search_urls(spark, sf_dir):
    title = F.concat("p_name", F.lit(' (100% "neu") & süß'))
    return roles.table(spark, sf_dir, "part").select("p_partkey", search_url(title).alias("url"))


# Words of the generated texts that take the parts of street, landmark and sub-district words.
PLACE_WORDS = dict(streets=["thtion", r"ver\.?"], street_ends=["the", "and", "de", "der", "of"],
                   landmarks=["keit", "ment", "dad"], subdistricts=["el", r"la\.?"])


def _phrase_sql() -> str:
    def words(starts, more):
        return rf"(?:{'|'.join(starts)})\s+[a-z0-9]+(?:\s+[a-z0-9]+){{0,{more}}}"

    ends = "|".join(PLACE_WORDS["street_ends"])
    street = rf"trim(regexp_replace(trim(regexp_extract(x, '{words(PLACE_WORDS['streets'], 3)}')), '\b({ends})\b.*', ''), chr(10) || ' ')"
    parts = [f"CASE WHEN length({street}) > 5 THEN {street} END"]
    for word in PLACE_WORDS["landmarks"]:
        hit = (rf"trim(regexp_replace(regexp_replace(regexp_extract(x, '{word}\S*(?:\s+\S+){{0,3}}'), '\s+', ' ', 'g'), "
               rf"'[^a-z0-9\s]', '', 'g'))")
        parts.append(f"CASE WHEN length({hit}) > 4 THEN {hit} END")
    parts.append(f"nullif(trim(regexp_extract(x, '{words(PLACE_WORDS['subdistricts'], 2)}')), '')")
    return f"""
WITH {DOCUMENTS_SQL.strip()},
lowered AS (SELECT doc_id, lower(coalesce(judul, '') || ' ' || coalesce(deskripsi_mentah, '')) AS x FROM docs)
SELECT doc_id, coalesce({', '.join(parts)}) || ', Surabaya' AS phrase FROM lowered"""


@query("place_phrase", _phrase_sql())
def place_phrases(spark, sf_dir):
    docs = roles.documents(spark, sf_dir)
    return docs.select("doc_id", place_phrase("judul", "deskripsi_mentah", **PLACE_WORDS).alias("phrase"))


# --- topics ---------------------------------------------------------------------------

TOPIC_STOPWORDS = ["the", "of", "and", "de", "la", "der", "und", "a", "is", "to", "en", "le"]
TOPIC_KEYWORDS = {"Kriminalitas": ["that", "with", "for", "was", "in", "on", "it"],
                  "Kesehatan": ["que", "ei", "des", "die", "des", "ment", "con", "les"]}

TOKENS_SQL = rf"""
tokens AS (
  SELECT doc_id, lang, list_filter(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s'),
         lambda w: NOT list_contains({TOPIC_STOPWORDS!r}, w)) AS words FROM documents),
pairs AS (SELECT doc_id, w AS term, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM tokens) GROUP BY ALL),
vocabulary AS (
  SELECT term, CAST(sum(n) AS BIGINT) AS total, count(*) AS doc_freq FROM pairs GROUP BY term HAVING count(*) >= 2)"""


def token_frame(spark, sf_dir):
    words = topics.without_stopwords(topics.tokens(F.col("text")), TOPIC_STOPWORDS)
    return roles.text_table(spark, sf_dir, "documents").select("doc_id", "lang", words.alias("words"))


@query("term_counts", f"""
WITH {TOKENS_SQL.strip()}
SELECT term, total, doc_freq, round(ln(((SELECT count(*) FROM documents) + 1) / (doc_freq + 1)), 6) AS idf FROM vocabulary""")
def term_counts(spark, sf_dir):
    frame = token_frame(spark, sf_dir)
    docs = roles.table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    return rounded(topics.term_table(frame, "words").withColumn("idf", topics.idf("doc_freq", docs)))


@query("idf_weights", f"""
WITH {TOKENS_SQL.strip()}
SELECT doc_id, term, n, round(n * ln(((SELECT count(*) FROM documents) + 1) / (doc_freq + 1)), 6) AS weight
FROM pairs JOIN vocabulary USING (term)""")
def idf_weights(spark, sf_dir):
    return rounded(topics.term_weights(token_frame(spark, sf_dir), "doc_id", "words"))


@query("keyword_label", f"""
WITH {TOKENS_SQL.strip()},
by_lang AS (SELECT lang, w AS term, count(*) AS n FROM (SELECT lang, unnest(words) AS w FROM tokens) GROUP BY ALL),
top AS (SELECT lang, term FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS r FROM by_lang) WHERE r <= 15),
scored AS (
  SELECT lang, count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kriminalitas']!r}, term)) AS crime_score,
         count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kesehatan']!r}, term)) AS health_score,
         string_agg(term, ' ' ORDER BY term) AS terms FROM top GROUP BY ALL)
SELECT lang, terms, crime_score, health_score,
       CASE WHEN crime_score >= health_score THEN 'Kriminalitas' ELSE 'Kesehatan' END AS label FROM scored""")
def keyword_label(spark, sf_dir):
    """The languages stand for topics: their 15 most frequent words vote for a label."""
    from pyspark.sql import Window

    counts = (token_frame(spark, sf_dir).select("lang", F.explode_outer("words").alias("term")).filter("term IS NOT NULL")
              .groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "term")
    top = counts.withColumn("r", F.row_number().over(w)).filter("r <= 15")
    listed = top.groupBy("lang").agg(F.array_sort(F.collect_list("term")).alias("words"))
    scores = topics.keyword_scores(F.col("words"), TOPIC_KEYWORDS)
    return listed.select("lang", F.array_join("words", " ").alias("terms"),
                         scores["Kriminalitas"].cast("long").alias("crime_score"),
                         scores["Kesehatan"].cast("long").alias("health_score"),
                         topics.keyword_label(F.col("words"), TOPIC_KEYWORDS).alias("label"))


@query("dominant_topic", f"""
WITH {_place_sql()}, vectors AS (
  SELECT doc_id, [length(text) - length(replace(text, 'e', '')), length(text) - length(replace(text, 'n', '')), length(text) - length(replace(text, 'a', ''))] AS v FROM documents)
SELECT doc_id, list_position(v, list_max(v)) - 1 AS dominant_topic FROM vectors""")
def dominant_topic(spark, sf_dir):
    """The letters e, n and a stand for topics, their counts for the weights: the first largest wins."""
    text = F.col("text")
    counts = F.array(*[(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double") for c in "ena"])
    docs = roles.text_table(spark, sf_dir, "documents").select("doc_id", counts.alias("v"))
    return docs.select("doc_id", topics.dominant("v").alias("dominant_topic"))


@query("topic_label_counts", f"""
WITH {TOKENS_SQL.strip()},
by_lang AS (SELECT lang, w AS term, count(*) AS n FROM (SELECT lang, unnest(words) AS w FROM tokens) GROUP BY ALL),
top AS (SELECT lang, term FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS r FROM by_lang) WHERE r <= 15),
labels AS (SELECT lang, CASE WHEN count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kriminalitas']!r}, term)) >=
                             count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kesehatan']!r}, term)) THEN 'Kriminalitas' ELSE 'Kesehatan' END AS label FROM top GROUP BY ALL)
SELECT source AS kecamatan, count(*) FILTER (label = 'Kriminalitas') AS total_kasus_berita_kriminal,
       count(*) FILTER (label = 'Kesehatan') AS total_kasus_berita_wabah FROM documents JOIN labels USING (lang) GROUP BY ALL""")
def topic_label_counts(spark, sf_dir):
    """Every document gets the label of its topic (its language); both labels are counted per source."""
    from ..operators.index import news_counts

    labels = keyword_label(spark, sf_dir).select("lang", "label")
    labelled = roles.table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(labels, "lang")
    return news_counts(labelled, "source", "label")


# --- topic weights for given topics: the languages of the documents ---------------------------

TOPIC_LANGS, TOPIC_ROUNDS = ["de", "en", "es", "fr"], 4

#: Texts of a block, which a Python worker holds; there are at least as many blocks as shuffle partitions.
BLOCK_BYTES = 64 << 20


def _psi(x: str) -> str:
    """The series of ``topics.digamma`` in SQL."""
    y = f"({x} + 6)"
    shifts = " - ".join(f"1 / ({x} + {i})" for i in range(6))
    return f"(ln({y}) - 0.5 / {y} - 1 / (12 * {y} * {y}) + 1 / (120 * pow({y}, 4)) - 1 / (252 * pow({y}, 6)) - {shifts})"


def _ln_gamma(x: str) -> str:
    y = f"({x} + 6)"
    shifts = " - ".join(f"ln({x} + {i})" for i in range(6))
    return (f"(({y} - 0.5) * ln({y}) - {y} + 0.5 * ln(2 * pi()) + 1 / (12 * {y}) - 1 / (360 * pow({y}, 3)) + 1 / (1260 * pow({y}, 5))"
            f" - {shifts})")


def _inference_sql() -> str:
    """Rounds of the E-step as one aggregate each: gammas g0 to g3 per document, expected weights e0 to e3."""
    k = range(len(TOPIC_LANGS))
    parts = [f"""
WITH {TOKENS_SQL.strip()},
by_topic AS (
  SELECT term, list_position({TOPIC_LANGS!r}, lang) - 1 AS topic, sum(n) AS n
  FROM pairs JOIN documents USING (doc_id) JOIN vocabulary USING (term) GROUP BY ALL),
sizes AS (SELECT topic, sum(n) AS size FROM by_topic GROUP BY topic),
beta AS (
  SELECT term, {', '.join(f"(coalesce(sum(n) FILTER (topic = {i}), 0) + 0.01::DOUBLE) / (coalesce((SELECT size FROM sizes WHERE topic = {i}), 0) + 0.01::DOUBLE * (SELECT count(DISTINCT term) FROM by_topic)) AS b{i}" for i in k)}
  FROM by_topic GROUP BY term),
words AS (SELECT doc_id, term, n::DOUBLE AS n, {', '.join(f'b{i}' for i in k)} FROM pairs JOIN beta USING (term)),
gamma0 AS (SELECT doc_id, sum(n) AS weight, {', '.join(f'sum(n) / 4 + 0.25::DOUBLE AS g{i}' for i in k)} FROM words GROUP BY doc_id)"""]
    whole = f"({' + '.join(f'g{i}' for i in k)})"
    for r in range(TOPIC_ROUNDS + 1):
        parts.append(f"logs{r} AS (SELECT *, {', '.join(f'{_psi(f'g{i}')} - {_psi(whole)} AS l{i}' for i in k)} FROM gamma{r})")
        parts.append(f"weights{r} AS (SELECT *, {', '.join(f'exp(l{i}) AS e{i}' for i in k)} FROM logs{r})")
        if r < TOPIC_ROUNDS:
            norm = f"({' + '.join(f'e{i} * b{i}' for i in k)})"
            parts.append(f"gamma{r + 1} AS (SELECT doc_id, any_value(weight) AS weight, "
                         f"{', '.join(f'any_value(e{i}) * sum(n * b{i} / {norm}) + 0.25::DOUBLE AS g{i}' for i in k)} "
                         f"FROM words JOIN weights{r} USING (doc_id) GROUP BY doc_id)")
    norm = f"({' + '.join(f'e{i} * b{i}' for i in k)})"
    prior = " + ".join(f"(0.25 - g{i}) * l{i} + {_ln_gamma(f'g{i}')} - {_ln_gamma('0.25::DOUBLE')}" for i in k)
    parts.append(f"""scored AS (
  SELECT w.doc_id, w.weight, {', '.join(f'g{i} / {whole} AS t{i}' for i in k)}, ll + {prior} + {_ln_gamma('1.0::DOUBLE')} - {_ln_gamma(whole)} AS bound
  FROM weights{TOPIC_ROUNDS} w JOIN (SELECT doc_id, sum(n * ln({norm})) AS ll FROM words JOIN weights{TOPIC_ROUNDS} USING (doc_id) GROUP BY doc_id) USING (doc_id))""")
    return ",\n".join(parts)


def token_rows(texts, *columns):
    """A row per token that is no stop word: its term, the text's topic (its language) and a hash that tells the text."""
    topic = (F.array_position(F.array(*[F.lit(x) for x in TOPIC_LANGS]), F.col("lang")) - 1).cast("int")
    rows = texts.select(*columns, topic.alias("topic"), F.xxhash64("doc_id", "lang").alias("own"),
                        F.explode_outer(topics.tokens(F.col("text"))).alias("term"))
    return rows.filter(F.col("term").isNotNull() & ~F.col("term").isin(TOPIC_STOPWORDS))


def inferred_topics(spark, sf_dir):
    """Topic weights of the documents under the languages' term probabilities.

    Documents are dealt to blocks by their id, as whole texts.  What is shuffled besides is a row per block and term: its
    counts on their way to the term, and the term's probabilities on their way back to the blocks that have it.  A table of
    documents and terms, several times as large as the texts, exists only within the tasks of the blocks.
    """
    docs, k = roles.text_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), len(TOPIC_LANGS)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BLOCK_BYTES)
    texts = docs.withColumn("block", F.pmod(F.hash("doc_id"), F.lit(blocks))).repartition(blocks, "block")
    in_block = topics.token_counts(token_rows(texts, "block"), "own", "topic", k, by=["block"]).drop("total")
    term = Window.partitionBy("term")
    listed = in_block.select("term", "block", *[F.sum(f"n{i}").over(term).alias(f"n{i}") for i in range(k)], F.min("first").over(term).alias("first"),
                             F.max("last").over(term).alias("last"), (F.col("block") == F.min("block").over(term)).alias("once"))
    known = listed.filter("first <> last")
    terms = topics.smoothed_terms(known, k, once=known.filter("once")).select("block", "term", "beta").repartition(blocks, "block")
    # Stop words are none of the terms.  The language goes along so that both uses of the texts are one exchange.
    words = texts.select("block", "doc_id", "lang", topics.tokens(F.col("text")).alias("words"))
    return topics.infer_texts(words, terms, "doc_id", "words", "block", k, rounds=TOPIC_ROUNDS)


@query("topic_weights", f"{_inference_sql()} SELECT doc_id, round(t0, 5) AS t0, round(t1, 5) AS t1, round(t2, 5) AS t2, round(t3, 5) AS t3, round(bound, 3) AS bound FROM scored")
def topic_weights(spark, sf_dir):
    """Topic weights of every document and its part of the likelihood bound, after a few rounds."""
    found = inferred_topics(spark, sf_dir)
    weights = [F.round(F.get("topic_distribution", F.lit(i)), 5).alias(f"t{i}") for i in range(len(TOPIC_LANGS))]
    return found.select("doc_id", *weights, F.round("bound", 3).alias("bound"))


@query("topic_likelihood", f"{_inference_sql()} SELECT round(sum(bound), 1) AS log_likelihood, round(-sum(bound) / sum(weight), 6) AS log_perplexity FROM scored")
def topic_likelihood(spark, sf_dir):
    """The scores of the topics over all documents: the bound, and its negative per word."""
    found = inferred_topics(spark, sf_dir)
    return found.agg(F.round(F.sum("bound"), 1).alias("log_likelihood"), F.round(-F.sum("bound") / F.sum("weight"), 6).alias("log_perplexity"))


TOPIC_WORDS_SQL = f"""
WITH {TOKENS_SQL.strip()},
numbered AS (SELECT term, row_number() OVER (ORDER BY total DESC, term) - 1 AS index FROM vocabulary),
by_topic AS (
  SELECT term, list_position({TOPIC_LANGS!r}, lang) - 1 AS topic, sum(n) AS n
  FROM pairs JOIN documents USING (doc_id) JOIN vocabulary USING (term) GROUP BY ALL),
first AS (
  SELECT topic, index, term, row_number() OVER (PARTITION BY topic ORDER BY n DESC, index) - 1 AS position
  FROM by_topic JOIN numbered USING (term) QUALIFY position < 15)"""


def words_of_topics(spark, sf_dir):
    from ..operators.rank import number_rows

    k = len(TOPIC_LANGS)
    vocabulary = topics.token_counts(token_rows(roles.text_table(spark, sf_dir, "documents")), "own", "topic", k).filter("first <> last").drop("first", "last")
    numbered = number_rows(vocabulary, [F.desc("total"), "term"], "index")  # kept, so the texts are read once
    return topics.topic_words(topics.smoothed_terms(numbered, k).select("term", "beta"), numbered.select("index", "term"), k)


@query("topic_terms", f"{TOPIC_WORDS_SQL} SELECT topic::INTEGER AS topic, position::INTEGER AS position, index, term FROM first")
def described_topics(spark, sf_dir):
    """The 15 heaviest terms of each topic, by index and by word."""
    return words_of_topics(spark, sf_dir)


@query("topic_labels", f"""{TOPIC_WORDS_SQL},
labels AS (
  SELECT topic, CASE WHEN count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kriminalitas']!r}, term)) >=
                          count(*) FILTER (list_contains({TOPIC_KEYWORDS['Kesehatan']!r}, term)) THEN 'Kriminalitas' ELSE 'Kesehatan' END AS label
  FROM first GROUP BY topic)
SELECT doc_id, (list_position({TOPIC_LANGS!r}, lang) - 1)::INTEGER AS topic, coalesce(label, 'Unknown') AS label
FROM documents LEFT JOIN labels ON topic = list_position({TOPIC_LANGS!r}, lang) - 1""")
def labelled_topics(spark, sf_dir):
    """The words of each topic vote for its label; a map brings the label to the documents of the topic (their language)."""
    words = words_of_topics(spark, sf_dir).groupBy("topic").agg(F.collect_list("term").alias("terms"))
    labels = {r.topic: r.label for r in words.select("topic", topics.keyword_label(F.col("terms"), TOPIC_KEYWORDS).alias("label")).collect()}
    topic = (F.array_position(F.array(*[F.lit(x) for x in TOPIC_LANGS]), F.col("lang")) - 1).cast("int")
    docs = roles.table(spark, sf_dir, "documents").select("doc_id", topic.alias("topic"))
    return docs.select("doc_id", "topic", topics.label_of_topic(F.col("topic"), labels).alias("label"))


@query("index_without_news", f"""
WITH {roles.PEOPLE_SQL.strip()},
crime0 AS (SELECT kecamatan, coalesce(returned, 0) AS total_kasus_kriminal,
                  CAST(coalesce(returned, 0) AS DOUBLE) / nullif(jumlah_penduduk, 0) * 100000 AS rate FROM base LEFT JOIN lines USING (nk))
SELECT kecamatan, total_kasus_kriminal, round((rate - min(rate) OVER ()) / CASE WHEN max(rate) OVER () > min(rate) OVER ()
       THEN max(rate) OVER () - min(rate) OVER () ELSE 1.0 END * 100, 6) AS indeks_kriminalitas FROM crime0""")
def index_without_news(spark, sf_dir):
    """The news table is not there yet: no topics, no counts, and the index comes from the baseline."""
    from ..operators.clean import NEWS_SCHEMA
    from ..operators.index import crime_index
    from ..sources import readers, writers

    news = readers.read_or_empty(spark, writers.scratch_dir(spark, "absent"), NEWS_SCHEMA)
    counts = topics.topic_counts(news).counts
    crime = crime_index(roles.districts(spark, sf_dir, returned=True), counts)
    return rounded(crime.select("kecamatan", "total_kasus_kriminal", "indeks_kriminalitas"))


_FITTED: dict[tuple, str] = {}


def document_topics(spark, sf_dir, part: str, fit: bool = False):
    """One part of the topic model of the documents; the model is fitted if ``fit`` says so or these texts have none yet.

    A fitted model belongs to the session, the folder and a fingerprint of the texts, so a changed table gets a new one.
    """
    from ..sources import writers

    print_of = roles.text_table(spark, sf_dir, "documents").agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("doc_id", "text")), F.bit_xor(F.xxhash64("text", "doc_id"))).first()
    key = spark.sparkContext.applicationId, sf_dir, *print_of
    if fit or key not in _FITTED:
        news = placed_documents(spark, sf_dir).withColumn("id_berita", F.col("doc_id"))
        result = topics.topic_counts(news, stopwords=TOPIC_STOPWORDS, keywords=TOPIC_KEYWORDS)
        path = writers.scratch_dir(spark, "topics")
        for name in ("scored", "counts", "metrics"):
            writers.overwrite(getattr(result, name), f"{path}/{name}")
        result.release()
        _FITTED[key] = path
    return spark.read.parquet(f"{_FITTED[key]}/{part}")


@query("lda_topics")
def lda_topics(spark, sf_dir):
    return document_topics(spark, sf_dir, "scored").select("id_berita", "kecamatan_terdeteksi", "dominant_topic", "kategori_ml")


@query("lda_counts")
def lda_counts(spark, sf_dir):
    return document_topics(spark, sf_dir, "counts")


@query("lda_metrics")
def lda_metrics(spark, sf_dir):
    """The fit itself, each time; the other two queries read what was fitted last."""
    return document_topics(spark, sf_dir, "metrics", fit=True)
