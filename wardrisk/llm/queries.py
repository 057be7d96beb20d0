"""The operators' queries over the test tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, decontamination, hamming_search, hard_negatives, license_scan, packing, quality_model, quality_rules, simhash, suffix_dedup,
               token_counts, training_order)
from .shared import read, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add


@query("op1_length_histogram")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(read(spark, sf_dir, "documents")))


@query("op2_golay_simhash")
def golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read(spark, sf_dir, "documents"))


@query("op3_training_order")
def feistel_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of all documents, written to the shared folder and read back."""
    path = f"{shared_folder(spark)}/llm/order-{uuid.uuid4().hex}"
    training_order.materialise(read(spark, sf_dir, "documents"), path)
    return training_order.materialised(spark, path)


@query("op4_tokenizer_fertility")
def tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents"))


@query("op5_rare_token_licences")
def rare_token_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


@query("op6_byte_network")
def byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality_model.fit(docs, read(spark, sf_dir, "labels"))
    return quality_model.score(docs, net).select(
        "doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


@query("op7_transducer_bpe")
def transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"))


@query("op8_multi_index_hashing", """
WITH bits AS (
  SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS bits
  FROM embeddings),
near AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, hamming(q.bits, x.bits) AS distance
  FROM bits q JOIN bits x ON q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, distance::INTEGER AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM near)
WHERE rank <= 10
""")
def multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    queries = codes.where("id % 100 = 0").withColumnRenamed("id", "query_id")
    return hamming_search.top_k(codes, queries, 10).withColumnRenamed("id", "vec_id")


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op10_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(read(spark, sf_dir, "documents"), ("doc_id",)).drop("kept_text")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op11_window_decontamination", f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, gram)),
spread AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN spread USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_misra_gries_collocations", rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words JOIN range(1, 6) AS sizes(k) ON len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, k, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS rest
  FROM counts JOIN range(1, 5) AS places(j) ON j < k),
scored AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, j, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head JOIN counts y ON y.lang = cuts.lang AND y.phrase = rest
       JOIN totals ON totals.lang = cuts.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scored) WHERE place = 1),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM counts d WHERE d.lang = best.lang AND d.k > best.k AND d.f >= best.a
           AND contains(' ' || d.phrase || ' ', ' ' || best.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
""")
def misra_gries_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query("op13_bond_hard_negatives", """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM scores WHERE same) WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT same
       AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
WHERE rank <= 10
""")
def bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)
