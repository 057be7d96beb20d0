"""Index queries: both indices and everything derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import clean, index, rank, report
from . import roles
from .registry import query
from .roles import BOTH_SQL, CRIME_SQL, HEALTH_SQL, PEOPLE_SQL


def rounded(df, digits=6):
    """Round the double columns for display."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


@query("rate_index", f"""
WITH {CRIME_SQL}
SELECT kecamatan, kasus_kriminal_baseline, jumlah_penduduk, total_kasus_berita_kriminal, total_kasus_kriminal,
       round(crime_rate, 6) AS crime_rate, round(indeks_kriminalitas, 6) AS indeks_kriminalitas,
       row_number() OVER (ORDER BY indeks_kriminalitas DESC NULLS LAST, kecamatan) AS rank
FROM crime ORDER BY rank""")
def rate_index(spark, sf_dir):
    ranked = rank.rank_desc(roles.crime(spark, sf_dir), "indeks_kriminalitas", "kecamatan")
    return rounded(ranked).orderBy("rank")


@query("rate_index_by_region", f"""
WITH {CRIME_SQL}
SELECT region, kecamatan, round(crime_rate, 6) AS crime_rate, round((crime_rate - min(crime_rate) OVER w) /
       CASE WHEN max(crime_rate) OVER w > min(crime_rate) OVER w
            THEN max(crime_rate) OVER w - min(crime_rate) OVER w ELSE 1.0 END * 100, 6) AS indeks_kriminalitas,
       row_number() OVER (PARTITION BY region ORDER BY crime_rate DESC NULLS LAST, kecamatan) AS rank
FROM crime WINDOW w AS (PARTITION BY region)""")
def rate_index_by_region(spark, sf_dir):
    indexed = roles.crime(spark, sf_dir, by="region")
    ranked = rank.rank_desc(indexed, "crime_rate", "kecamatan", by="region")
    return rounded(ranked.select("region", "kecamatan", "crime_rate", "indeks_kriminalitas", "rank"))


@query("composite_index", f"""
WITH {PEOPLE_SQL}, {HEALTH_SQL}
SELECT kecamatan, jumlah_penduduk, kasus_wabah_baseline, total_kasus_berita_wabah, total_faskes, total_kasus_wabah,
       round(incidence_rate, 6) AS incidence_rate, round(hfr, 6) AS hfr, round(norm_ir, 6) AS norm_ir,
       round(norm_hfr, 6) AS norm_hfr, round(indeks_kesehatan, 6) AS indeks_kesehatan
FROM health""")
def composite_index(spark, sf_dir):
    return rounded(roles.health(spark, sf_dir))


@query("dual_recap", f"""
WITH {BOTH_SQL}
SELECT kecamatan, round(indeks_kriminalitas, 6) AS indeks_kriminalitas,
       round(coalesce(h.indeks_kesehatan, 0), 6) AS indeks_kesehatan
FROM crime LEFT JOIN health h USING (kecamatan) ORDER BY kecamatan""")
def dual_recap(spark, sf_dir):
    return rounded(report.dual_recap(roles.risk(spark, sf_dir))).orderBy("kecamatan")


RANKED_SQL = f"""
WITH {BOTH_SQL},
both_rows AS (
  SELECT kecamatan, c.total_kasus_kriminal, c.crime_rate, indeks_kriminalitas, h.total_kasus_wabah, h.hfr, indeks_kesehatan,
         row_number() OVER (ORDER BY indeks_kriminalitas DESC NULLS LAST, kecamatan) AS crime_rank,
         row_number() OVER (ORDER BY indeks_kesehatan DESC NULLS LAST, kecamatan) AS health_rank
  FROM crime c JOIN health h USING (kecamatan))"""

LEVEL_SQL = "CASE WHEN {0} >= 80 THEN 'EKSTRIM' WHEN {0} >= 60 THEN 'TINGGI' WHEN {0} >= 40 THEN 'SEDANG' ELSE 'RENDAH' END"
STEP_SQL = "CASE WHEN {0} >= 80 THEN '4' WHEN {0} >= 60 THEN '3' WHEN {0} >= 40 THEN '2' WHEN {0} >= 20 THEN '1' ELSE '0' END"


def headlines(spark, sf_dir):
    return report.headline_lists(roles.event_news(spark, sf_dir), "kecamatan_terdeteksi", "judul", "tanggal_publikasi", "id_berita")


@query("profile", f"""
{RANKED_SQL}, {roles.NEWS_SQL.strip()},
late AS (
  SELECT kecamatan_terdeteksi AS kecamatan, string_agg(judul, '; ' ORDER BY p) AS headlines FROM (
    SELECT *, row_number() OVER (PARTITION BY kecamatan_terdeteksi ORDER BY tanggal_publikasi DESC, id_berita) AS p
    FROM news_rows) WHERE p <= 3 GROUP BY ALL)
SELECT kecamatan, total_kasus_kriminal, round(coalesce(crime_rate, 0), 6) AS crime_rate, crime_rank,
       round(coalesce(indeks_kriminalitas, 0), 6) AS indeks_kriminalitas, total_kasus_wabah,
       round(coalesce(hfr, 0), 6) AS hfr, round(coalesce(indeks_kesehatan, 0), 6) AS indeks_kesehatan, health_rank,
       {LEVEL_SQL.format('indeks_kriminalitas')} AS risk_level, {STEP_SQL.format('indeks_kriminalitas')} AS crime_step,
       {STEP_SQL.format('indeks_kesehatan')} AS health_step, coalesce(headlines, '') AS headlines
FROM both_rows LEFT JOIN late USING (kecamatan)""")
def profile(spark, sf_dir):
    return rounded(report.profile(roles.risk(spark, sf_dir), headlines=headlines(spark, sf_dir)))


@query("risk_report", f"""
{RANKED_SQL}, shown AS (
  SELECT *, coalesce(round(indeks_kriminalitas, 1), 0) AS crime_shown, coalesce(round(indeks_kesehatan, 1), 0) AS health_shown
  FROM both_rows)
SELECT kecamatan, crime_shown, health_shown, crime_rank, health_rank, total_kasus_kriminal, total_kasus_wabah,
       {LEVEL_SQL.format('crime_shown')} AS risk_level,
       CASE WHEN crime_shown >= 60 THEN '{fixed.CRIME_ADVICE[0][0]}' WHEN crime_shown >= 40 THEN '{fixed.CRIME_ADVICE[1][0]}'
            ELSE '{fixed.CRIME_ADVICE[2][0]}' END AS crime_advice,
       CASE WHEN indeks_kesehatan >= 50 THEN '{fixed.HEALTH_ADVICE[0][0]}' ELSE '{fixed.HEALTH_ADVICE[1][0]}' END AS health_advice,
       printf('%.3f', coalesce(crime_rate, 0)) AS crime_rate_shown,
       CASE WHEN crime_shown > health_shown THEN '{fixed.PRIORITY_CRIME}' ELSE '{fixed.PRIORITY_HEALTH}' END AS priority,
       printf('%.2f', coalesce(hfr, 0) * 100) || '%' AS hfr_shown
FROM shown""")
def risk_report(spark, sf_dir):
    return report.risk_report(roles.risk(spark, sf_dir))


@query("city_summary", f"""
WITH {BOTH_SQL}, yearly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY ALL)
SELECT CAST(sum(total_kasus_kriminal) AS BIGINT) AS total_crime, round(avg(indeks_kriminalitas), 6) AS mean_crime_index,
       count(*) AS districts, (SELECT CAST(sum(total_kasus_wabah) AS BIGINT) FROM health) AS total_health,
       (SELECT round(avg(indeks_kesehatan), 6) FROM health) AS mean_health_index,
       (SELECT kecamatan FROM crime WHERE indeks_kriminalitas IS NOT NULL ORDER BY indeks_kriminalitas DESC, kecamatan LIMIT 1) AS worst_crime,
       (SELECT kecamatan FROM crime WHERE indeks_kriminalitas IS NOT NULL ORDER BY indeks_kriminalitas, kecamatan DESC LIMIT 1) AS best_crime,
       (SELECT kecamatan FROM health WHERE indeks_kesehatan IS NOT NULL ORDER BY indeks_kesehatan DESC, kecamatan LIMIT 1) AS worst_health,
       (SELECT round((arg_max(n, year)::DOUBLE - arg_min(n, year)) / arg_min(n, year) * 100, 0) FROM yearly) AS change_percent
FROM crime""")
def city_summary(spark, sf_dir):
    from ..operators.reshape import trend_change

    yearly = (roles.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"))
              .agg(F.count(F.lit(1)).alias("n")))
    change = trend_change(yearly, "year", "n").select("change_percent")
    return rounded(report.city_summary(roles.risk(spark, sf_dir), change))


@query("kpi_row", f"""
WITH {BOTH_SQL}
SELECT count(*) AS districts, arg_min(kecamatan, (-indeks_kriminalitas, kecamatan)) AS top_crime,
       round(max(indeks_kriminalitas), 1) AS top_crime_value,
       (SELECT arg_min(kecamatan, (-indeks_kesehatan, kecamatan)) FROM health) AS top_health,
       (SELECT round(max(indeks_kesehatan), 1) FROM health) AS top_health_value,
       (SELECT count(*) FROM events) AS news_total
FROM crime""")
def kpi_row(spark, sf_dir):
    return report.kpi_row(roles.risk(spark, sf_dir), roles.table(spark, sf_dir, "events"))


@query("pair_compare", f"""
WITH {BOTH_SQL}, two AS (
  SELECT kecamatan, indeks_kriminalitas, total_kasus_kriminal::DOUBLE AS cases, crime_rate, indeks_kesehatan,
         total_kasus_wabah::DOUBLE AS disease, hfr
  FROM crime JOIN (SELECT kecamatan, indeks_kesehatan, total_kasus_wabah, hfr FROM health) USING (kecamatan)
  WHERE kecamatan IN ('NATION_3', 'NATION_7')),
long AS (
  SELECT kecamatan, unnest(['indeks_kriminalitas', 'total_kasus_kriminal', 'crime_rate', 'indeks_kesehatan', 'total_kasus_wabah', 'hfr']) AS figure,
         unnest([indeks_kriminalitas, cases, crime_rate, indeks_kesehatan, disease, hfr]) AS v FROM two),
ab AS (SELECT figure, max(v) FILTER (kecamatan = 'NATION_3') AS a, max(v) FILTER (kecamatan = 'NATION_7') AS b FROM long GROUP BY ALL)
SELECT figure, round(a, 6) AS value_a, round(b, 6) AS value_b,
       CASE WHEN figure LIKE 'indeks%' THEN CASE WHEN a <= b THEN '▼' ELSE '▲' END END AS mark_a,
       CASE WHEN figure LIKE 'indeks%' THEN CASE WHEN a <= b THEN '▲' ELSE '▼' END END AS mark_b
FROM ab""")
def pair_compare(spark, sf_dir):
    return rounded(report.compare(roles.risk(spark, sf_dir), "NATION_3", "NATION_7"))


@query("top_n", f"""
WITH {CRIME_SQL} SELECT kecamatan, round(indeks_kriminalitas, 6) AS indeks_kriminalitas FROM crime
ORDER BY crime.indeks_kriminalitas DESC NULLS LAST, kecamatan LIMIT 10""")
def top_n(spark, sf_dir):
    table = roles.crime(spark, sf_dir).select("kecamatan", "indeks_kriminalitas")
    return rounded(rank.top_n(table, "indeks_kriminalitas", 10, "kecamatan"))


@query("bottom_n", f"""
WITH {PEOPLE_SQL}, {HEALTH_SQL} SELECT kecamatan, round(indeks_kesehatan, 6) AS indeks_kesehatan FROM health
ORDER BY health.indeks_kesehatan ASC NULLS FIRST, kecamatan DESC LIMIT 5""")
def bottom_n(spark, sf_dir):
    table = roles.health(spark, sf_dir).select("kecamatan", "indeks_kesehatan")
    return rounded(rank.bottom_n(table, "indeks_kesehatan", 5, "kecamatan"))


@query("worst_best", f"""
WITH {CRIME_SQL}
SELECT arg_min(kecamatan, (-indeks_kriminalitas, kecamatan)) AS worst, round(max(indeks_kriminalitas), 6) AS worst_value,
       arg_max(kecamatan, (-indeks_kriminalitas, kecamatan)) AS best, round(min(indeks_kriminalitas), 6) AS best_value
FROM crime WHERE indeks_kriminalitas IS NOT NULL""")
def worst_best(spark, sf_dir):
    return rounded(rank.worst_best(roles.crime(spark, sf_dir), "indeks_kriminalitas", "kecamatan"))


@query("band_histogram", f"""
WITH {CRIME_SQL}
SELECT * FROM (VALUES
  (0, 'Ekstrim (>80)', (SELECT count(*) FROM crime WHERE indeks_kriminalitas > 80)),
  (1, 'Tinggi (60-80)', (SELECT count(*) FROM crime WHERE indeks_kriminalitas >= 60 AND indeks_kriminalitas <= 80)),
  (2, 'Sedang (40-60)', (SELECT count(*) FROM crime WHERE indeks_kriminalitas >= 40 AND indeks_kriminalitas < 60)),
  (3, 'Waspada (20-40)', (SELECT count(*) FROM crime WHERE indeks_kriminalitas >= 20 AND indeks_kriminalitas < 40)),
  (4, 'Aman (<20)', (SELECT count(*) FROM crime WHERE indeks_kriminalitas < 20))) AS t(position, band, n)""")
def band_histogram(spark, sf_dir):
    return rank.band_histogram(roles.crime(spark, sf_dir), "indeks_kriminalitas", fixed.CRIME_ZONES)


@query("band_histogram_health", f"""
WITH {PEOPLE_SQL}, {HEALTH_SQL}
SELECT * FROM (VALUES
  (0, 'Kritis (>75)', (SELECT count(*) FROM health WHERE indeks_kesehatan > 75)),
  (1, 'Tinggi (50-75)', (SELECT count(*) FROM health WHERE indeks_kesehatan >= 50 AND indeks_kesehatan <= 75)),
  (2, 'Sedang (25-50)', (SELECT count(*) FROM health WHERE indeks_kesehatan >= 25 AND indeks_kesehatan < 50)),
  (3, 'Rendah (<25)', (SELECT count(*) FROM health WHERE indeks_kesehatan < 25))) AS t(position, band, n)""")
def band_histogram_health(spark, sf_dir):
    return rank.band_histogram(roles.health(spark, sf_dir), "indeks_kesehatan", fixed.HEALTH_ZONES)


@query("above_thresholds", f"""
WITH {CRIME_SQL}
SELECT count(*) FILTER (indeks_kriminalitas > 80) AS above_80, count(*) FILTER (indeks_kriminalitas > 70) AS above_70,
       count(*) FILTER (indeks_kriminalitas > 50) AS above_50 FROM crime""")
def above_thresholds(spark, sf_dir):
    return rank.above(roles.crime(spark, sf_dir), "indeks_kriminalitas", [80, 70, 50])


@query("find_place", f"""
WITH {CRIME_SQL}
SELECT kecamatan, round(indeks_kriminalitas, 6) AS indeks_kriminalitas FROM crime
WHERE starts_with(lower(kecamatan), 'nation_1') ORDER BY crime.indeks_kriminalitas DESC, kecamatan LIMIT 1""")
def find_place(spark, sf_dir):
    table = roles.crime(spark, sf_dir).select("kecamatan", "indeks_kriminalitas")
    return rounded(clean.find_place(table, "kecamatan", "Nation_1", "indeks_kriminalitas"))


@query("name_search", f"""
WITH {CRIME_SQL}
SELECT kecamatan, total_kasus_kriminal FROM crime WHERE contains(lower(kecamatan), 'n_2')""")
def name_search(spark, sf_dir):
    return clean.name_contains(roles.crime(spark, sf_dir), "kecamatan", " N_2 ").select("kecamatan", "total_kasus_kriminal")


@query("news_detail", f"""
WITH {BOTH_SQL}, {roles.NEWS_SQL.strip()},
ranked AS (SELECT kecamatan, indeks_kriminalitas, row_number() OVER (ORDER BY indeks_kriminalitas DESC NULLS LAST, kecamatan) AS r FROM crime)
SELECT event_id, kecamatan_terdeteksi, round(c.indeks_kriminalitas, 6) AS indeks_kriminalitas,
       round(h.indeks_kesehatan, 6) AS indeks_kesehatan, coalesce(r, 0) AS crime_rank
FROM news_rows LEFT JOIN ranked c ON c.kecamatan = kecamatan_terdeteksi LEFT JOIN health h ON h.kecamatan = kecamatan_terdeteksi""")
def news_detail(spark, sf_dir):
    news = roles.event_news(spark, sf_dir).select("event_id", "kecamatan_terdeteksi")
    return rounded(report.news_detail(news, roles.risk(spark, sf_dir), "kecamatan_terdeteksi"))


@query("lookup_by_name", f"""
WITH {CRIME_SQL}
SELECT s_suppkey, round(coalesce(indeks_kriminalitas, 0), 6) AS indeks_kriminalitas
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_suppkey % 10 <> 0 LEFT JOIN crime ON kecamatan = n_name""")
def lookup_by_name(spark, sf_dir):
    """Suppliers carry the district in other spellings; every tenth one names no known place."""
    names = roles.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    spelled = F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.lit("Darmo "), "n_name")).otherwise(
        F.concat(F.lit("Kecamatan "), F.initcap("n_name"), F.lit(" ")))
    suppliers = roles.table(spark, sf_dir, "supplier").join(names, "s_nationkey").select("s_suppkey", spelled.alias("place"))
    table = roles.crime(spark, sf_dir).select("kecamatan", "indeks_kriminalitas")
    # The table has every district in a second spelling too, with another value: the first name in order counts.
    twice = table.unionByName(table.select(F.concat(F.lit("kecamatan "), F.lower("kecamatan")), F.lit(-1.0)).toDF(*table.columns))
    found = report.lookup_by_name(suppliers, twice, "place", "kecamatan", ["indeks_kriminalitas"])
    return rounded(found.drop("place"))


@query("district_context", f"""
{RANKED_SQL}, {roles.NEWS_SQL.strip()},
late AS (
  SELECT kecamatan_terdeteksi AS kecamatan, string_agg(judul, '; ' ORDER BY p) AS headlines FROM (
    SELECT *, row_number() OVER (PARTITION BY kecamatan_terdeteksi ORDER BY tanggal_publikasi DESC, id_berita) AS p
    FROM news_rows) WHERE p <= 3 GROUP BY ALL)
SELECT kecamatan, concat_ws(chr(10),
  'Kriminalitas: indeks=' || printf('%.1f', indeks_kriminalitas) || '/100, total_kasus=' || total_kasus_kriminal || ', crime_rate=' || printf('%.1f', crime_rate),
  'Kesehatan: indeks=' || printf('%.1f', indeks_kesehatan) || '/100, total_wabah=' || total_kasus_wabah || ', HFR=' || printf('%.2f', hfr),
  'Berita terkini: ' || headlines) AS context
FROM both_rows LEFT JOIN late USING (kecamatan)""")
def district_context(spark, sf_dir):
    return report.district_context(roles.risk(spark, sf_dir), headlines(spark, sf_dir))


@query("city_context", f"""
WITH {BOTH_SQL}
SELECT (SELECT string_agg(t, ', ' ORDER BY i DESC, kecamatan) FROM (SELECT kecamatan, indeks_kriminalitas AS i,
          kecamatan || '(' || printf('%.1f', indeks_kriminalitas) || ')' AS t FROM crime ORDER BY i DESC, kecamatan LIMIT 3)) AS top_crime,
       (SELECT string_agg(t, ', ' ORDER BY i DESC, kecamatan) FROM (SELECT kecamatan, indeks_kesehatan AS i,
          kecamatan || '(' || printf('%.1f', indeks_kesehatan) || ')' AS t FROM health ORDER BY i DESC, kecamatan LIMIT 3)) AS top_health,
       count(*) AS districts, CAST(sum(total_kasus_kriminal) AS BIGINT) AS total_crime,
       (SELECT CAST(sum(total_kasus_wabah) AS BIGINT) FROM health) AS total_health
FROM crime""")
def city_context(spark, sf_dir):
    return report.city_context(roles.risk(spark, sf_dir))


@query("news_multiplier", f"""
WITH {CRIME_SQL}
SELECT kecamatan, kasus_kriminal_baseline AS cases, total_kasus_berita_kriminal AS news,
       round(kasus_kriminal_baseline * (1 + 0.5 * coalesce(total_kasus_berita_kriminal / nullif(avg(total_kasus_berita_kriminal) OVER (), 0), 0)), 6) AS calibrated
FROM crime""")
def news_multiplier(spark, sf_dir):
    base = (roles.districts(spark, sf_dir, returned=True)
            .select("kecamatan", F.col("jumlah_kasus").alias("cases")))
    counts = roles.event_counts(spark, sf_dir).select("kecamatan", F.col("total_kasus_berita_kriminal").alias("news"))
    return rounded(index.news_multiplier(base, counts, "kecamatan", "cases", "news", 0.5, "calibrated"))


@query("customer_rank", """
SELECT c_custkey, row_number() OVER (ORDER BY floor(balance / 500) DESC NULLS LAST, c_custkey) AS rank
FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS balance FROM customer)""")
def customer_rank(spark, sf_dir):
    """A rank over a whole table: few distinct values, and a third of the rows without one."""
    balance = F.when(F.col("c_custkey") % 3 > 0, F.floor(F.col("c_acctbal") / 500))
    table = roles.table(spark, sf_dir, "customer").select("c_custkey", balance.alias("balance"))
    return rank.rank_desc(table, "balance", "c_custkey").select("c_custkey", "rank")


@query("customer_rank_by_nation", """
SELECT c_custkey, row_number() OVER (PARTITION BY nation ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rank
FROM (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_nationkey END AS nation FROM customer)""")
def customer_rank_by_nation(spark, sf_dir):
    """A rank per group of which one, without a key, holds a third of the rows."""
    group = F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey"))
    table = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", group.alias("nation"))
    return rank.rank_desc(table, "c_acctbal", "c_custkey", by="nation").select("c_custkey", "rank")
