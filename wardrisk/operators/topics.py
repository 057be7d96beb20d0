"""Topic modelling of news: tokens, term weights, LDA, labels and counts per district."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import IDF, CountVectorizerModel, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType
from pyspark.storagelevel import StorageLevel

from ..functions import document_text, fixed
from .index import KEY, news_counts


# --- tokens and weights as plain columns ---------------------------------------------

def tokens(c) -> Column:
    """Lower-case tokens split at each white-space character; trailing empty tokens go."""
    text = F.lower(c)
    kept = F.regexp_replace(text, r"\s+$", "")
    return F.when((kept == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(kept, r"\s"))


def without_stopwords(c, stopwords=fixed.TOPIC_STOPWORDS) -> Column:
    stop = F.array(*[F.lit(w.lower()) for w in stopwords])
    return F.filter(c, lambda w: ~F.array_contains(stop, w))


def term_table(df: DataFrame, words: str, min_df: float = 2, size: int | None = None) -> DataFrame:
    """Vocabulary ``(term, total, doc_freq)``: the terms of at least ``min_df`` texts, or the ``size`` most frequent.

    Each text sends its words for the total and its distinct words for the text count.
    Both are combined per task before the one shuffle, so a very frequent term stays
    cheap.  Ties at the end of the vocabulary are broken by the term.
    """
    def counted(c, n: int, docs: int) -> Column:
        return F.transform(c, lambda w: F.struct(w.alias("term"), F.lit(n).alias("n"), F.lit(docs).alias("docs")))

    pairs = F.concat(counted(words, 1, 0), counted(F.array_distinct(words), 0, 1))
    # The outer form: the inner one adds a filter that would split every text a second time.
    vocabulary = (df.select(F.inline_outer(pairs)).filter("term IS NOT NULL").groupBy("term")
                  .agg(F.sum("n").alias("total"), F.sum("docs").alias("doc_freq"))
                  .filter(F.col("doc_freq") >= min_df))
    return vocabulary if size is None else vocabulary.orderBy(F.desc("total"), "term").limit(size)


def idf(doc_freq, docs) -> Column:
    """Inverse document frequency with add-one smoothing."""
    return F.log((docs + 1) / (F.col(doc_freq) + 1))


def term_weights(df: DataFrame, id_col: str, words: str, min_df: int = 2, size: int | None = None) -> DataFrame:
    """``(id, term, n, weight)`` for the terms of the vocabulary, by default all of at least ``min_df`` texts.

    One table of counts per text feeds both the vocabulary and the weights; the join strategy is left
    to the sizes.
    """
    docs = df.agg(F.count(F.lit(1))).scalar()
    counts = (df.select(id_col, F.explode_outer(words).alias("term")).filter("term IS NOT NULL")
              .groupBy("term", id_col).agg(F.count(F.lit(1)).alias("n")))
    terms = counts.groupBy("term").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("doc_freq")).filter(F.col("doc_freq") >= min_df)
    if size is not None:
        terms = terms.orderBy(F.desc("total"), "term").limit(size)
    return counts.join(terms.select("term", idf("doc_freq", docs).alias("idf")), "term").select(
        id_col, "term", "n", (F.col("n") * F.col("idf")).alias("weight"))


# --- labels ---------------------------------------------------------------------------

def keyword_label(words, keywords: dict[str, list[str]] | None = None) -> Column:
    """Label whose keyword list shares most words with the array; the first label wins ties."""
    keywords = fixed.TOPIC_KEYWORDS if keywords is None else keywords
    scores = keyword_scores(words, keywords)
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    expr = F
    for label, score in scores.items():
        expr = expr.when(score == best, F.lit(label))
    return expr


def keyword_scores(words, keywords: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Size of the overlap with each keyword list."""
    keywords = fixed.TOPIC_KEYWORDS if keywords is None else keywords
    return {label: F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in listed])))
            for label, listed in keywords.items()}


def dominant(c) -> Column:
    """Position of the first largest element, from 0."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


# --- topic weights for given topics ------------------------------------------------------

def digamma(x, log=F.log):
    """Derivative of the log-gamma function for positive numbers, to some 1e-9: shifted by six, then its series.

    ``x`` is a column, or an array of numbers with ``log`` to match.
    """
    y = x + 6
    series = log(y) - 0.5 / y - 1 / (12 * y * y) + 1 / (120 * y ** 4) - 1 / (252 * y ** 6)
    return series - sum((1 / (x + i) for i in range(1, 6)), 1 / x)


def log_gamma(x, log=F.log):
    """Log-gamma for positive numbers, to some 1e-9, in the same way."""
    y = x + 6
    series = (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return series - sum((log(x + i) for i in range(1, 6)), log(x))


def token_counts(tokens: DataFrame, text: str, topic: str, k: int, by=()) -> DataFrame:
    """``(by, term, total, n0 ..., first, last)``: counts of each term and, by topic, of its tokens in the topics 0 to k - 1.

    ``tokens`` has a row per token; ``text`` is a 64-bit hash that tells its text.  A term's least and greatest hash differ
    if it is in two texts or more, so no table of texts and terms is needed: numbers are combined per task before the one
    shuffle.  Tokens of other topics count in the total alone.
    """
    in_topic = [F.count_if(F.col(topic) == i).alias(f"n{i}") for i in range(k)]
    return tokens.groupBy(*by, "term").agg(
        F.count(F.lit(1)).alias("total"), *in_topic, F.min(text).alias("first"), F.max(text).alias("last"))


def smoothed_terms(counts: DataFrame, k: int, smoothing: float = 0.01, once: DataFrame | None = None) -> DataFrame:
    """The rows and ``beta``: the term's probability in the topics 0 to k - 1, from its counts ``n0`` to ``n{k-1}``.

    ``once`` has each term in one row, if ``counts`` has not.
    """
    columns = [f"n{i}" for i in range(k)]
    sizes = (counts if once is None else once).agg(F.struct(F.count(F.lit(1)).alias("terms"), *[F.sum(c).alias(c) for c in columns])).scalar()
    beta = F.array(*[(F.coalesce(F.col(c), F.lit(0)) + smoothing)
                     / (F.coalesce(F.col("_sizes")[c], F.lit(0)) + F.col("_sizes")["terms"] * smoothing) for c in columns])
    return counts.withColumn("_sizes", sizes).withColumn("beta", beta).drop("_sizes")


def topic_terms(counts: DataFrame, topic: str, term: str, n: str, k: int, smoothing: float = 0.01) -> DataFrame:
    """``(term, beta)``: each term's probability in the topics 0 to k - 1, from its counts per topic, smoothed.

    ``counts`` has a row per topic and term; terms with no count in a topic have the smoothing alone.
    """
    listed = counts.groupBy(F.col(term).alias("term")).agg(*[F.sum(F.when(F.col(topic) == i, F.col(n))).alias(f"n{i}") for i in range(k)])
    return smoothed_terms(listed, k, smoothing).select("term", "beta")


def e_step(n: np.ndarray, beta: np.ndarray, starts: np.ndarray, alpha: float, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Topic weights, bound and total count of texts under given topics: the variational E-step of LDA.

    ``n`` and the rows of ``beta`` are the counts and topic probabilities of the texts' terms, text by text; ``starts`` has
    the place of each text's first term.
    """
    k, sizes, weight = beta.shape[1], np.diff(starts, append=len(n)), np.add.reduceat(n, starts)
    gamma = np.repeat(weight[:, None] / k + alpha, k, axis=1)

    def expected() -> np.ndarray:
        """Expected log weight of each topic."""
        return digamma(gamma, np.log) - digamma(gamma.sum(axis=1, keepdims=True), np.log)

    for _ in range(rounds):
        e = np.exp(expected())
        shares = n / np.einsum("ij,ij->i", np.repeat(e, sizes, axis=0), beta)
        gamma = e * np.add.reduceat(shares[:, None] * beta, starts) + alpha
    logs = expected()
    words = np.add.reduceat(n * np.log(np.einsum("ij,ij->i", np.repeat(np.exp(logs), sizes, axis=0), beta)), starts)
    prior = ((alpha - gamma) * logs + log_gamma(gamma, np.log) - math.lgamma(alpha)).sum(axis=1)
    total = gamma.sum(axis=1)
    return gamma / total[:, None], words + prior + math.lgamma(k * alpha) - log_gamma(total, np.log), weight


def scored_texts(names: list[str], ids: pa.Array, n: np.ndarray, beta: np.ndarray, starts: np.ndarray, alpha: float, rounds: int) -> pa.RecordBatch:
    """The result of e_step() under the ids of the texts."""
    weights, bound, weight = e_step(n, beta, starts, alpha, rounds)
    lists = pa.ListArray.from_arrays(np.arange(len(bound) + 1, dtype=np.int32) * beta.shape[1], weights.ravel())
    return pa.RecordBatch.from_arrays([ids, lists, pa.array(bound), pa.array(weight)], names=names)


def infer_topics(counts: DataFrame, terms: DataFrame, id_col: str, k: int, alpha: float | None = None, rounds: int = 20) -> DataFrame:
    """``(id, topic_distribution, bound, weight)`` of each text under given topics: the variational E-step of LDA.

    ``counts``: id, term, n; ``terms``: term, beta (see :func:`topic_terms`).  A text's terms meet in one row, so nothing is
    shuffled between rounds.  ``bound`` is the text's part of the variational lower bound of the log likelihood, ``weight``
    its total count.  Texts without a known term are left out.  Counts pass through two shuffles, to the terms and to the
    texts; :func:`infer_texts` starts from the texts and needs neither.
    """
    alpha = 1.0 / k if alpha is None else alpha
    word = F.struct("term", F.col("n").cast("double").alias("n"), "beta")
    rows = counts.join(terms, "term").groupBy(id_col).agg(F.array_sort(F.collect_list(word)).alias("_words"))
    rows = rows.select(id_col, F.transform("_words", lambda w: w["n"]).alias("n"), F.flatten(F.transform("_words", lambda w: w["beta"])).alias("beta"))
    names = [id_col, "topic_distribution", "bound", "weight"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, beta = batch.column("n"), batch.column("beta").flatten().to_numpy().reshape(-1, k)
                starts = n.offsets.to_numpy()[:-1] - n.offsets[0].as_py()
                yield scored_texts(names, batch.column(0), n.flatten().to_numpy(), beta, starts, alpha, rounds)

    return rows.mapInArrow(score, _scored_schema(counts, id_col))


def _scored_schema(df: DataFrame, id_col: str) -> StructType:
    number = DoubleType()
    return df.select(id_col).schema.add("topic_distribution", ArrayType(number)).add("bound", number).add("weight", number)


#: So many words of a block are counted at a time, whole texts.
SLICE_WORDS = 1_000_000


def infer_texts(texts: DataFrame, terms: DataFrame, id_col: str, words: str, block: str, k: int, alpha: float | None = None, rounds: int = 20) -> DataFrame:
    """Like :func:`infer_topics`, from the words of the texts themselves.

    ``block``, in both tables, is a number that follows from the id, and ``terms`` has the terms of each block (block, term,
    beta).  Where both tables are partitioned by it nothing more is shuffled.  A Python worker holds one block at a time; rows
    with the same id, or with none, are one text.
    """
    alpha = 1.0 / k if alpha is None else alpha
    names = [id_col, "topic_distribution", "bound", "weight"]
    schema = _scored_schema(texts, id_col)

    def score(texts: pa.Table, terms: pa.Table) -> pa.Table:
        ids = texts.column(id_col).combine_chunks().dictionary_encode("encode")
        text, known = ids.indices.to_numpy(), pa.concat_arrays([*terms.column("term").chunks, pa.array([], pa.string())])
        beta = np.concatenate([np.empty(0), *[x.flatten().to_numpy() for x in terms.column("beta").chunks]]).reshape(-1, k)
        size, place, none = [np.empty(0, np.int64)], [np.empty(0, np.int32)], pa.array([], pa.list_(pa.float64()))
        for chunk in texts.column(words).chunks:
            size.append(pc.fill_null(pc.list_value_length(chunk), 0).to_numpy())
            place.append(pc.fill_null(pc.index_in(chunk.flatten(), value_set=known), -1).to_numpy())
        size, place = np.concatenate(size), np.concatenate(place)
        first, rows = np.cumsum(size) - size, np.argsort(text, kind="stable")
        last = np.flatnonzero(np.diff(text[rows], append=-1))  # row of each text
        ends = last[np.diff(np.cumsum(size[rows])[last] // SLICE_WORDS, append=-1) != 0] + 1
        scored = []
        for start, end in zip([0, *ends], ends):
            some = rows[start:end]
            ahead = first[some] - np.cumsum(size[some]) + size[some]
            term = place[np.arange(size[some].sum()) + np.repeat(ahead, size[some])]
            pair = np.repeat(text[some].astype(np.int64), size[some]) * len(known) + term
            pairs, n = np.unique(pair[term >= 0], return_counts=True)
            if len(pairs):
                owner, starts = np.unique(pairs // len(known), return_index=True)
                own = ids.dictionary.take(pa.array(owner))
                scored.append(scored_texts(names, own, n.astype(float), beta[pairs % len(known)], starts, alpha, rounds))
        empty = pa.RecordBatch.from_arrays([ids.dictionary[:0], none, none.values, none.values], names=names)
        return pa.Table.from_batches(scored or [empty])

    # A cogroup's function gets and returns a block as a whole.
    return texts.groupBy(block).cogroup(terms.groupBy(block)).applyInArrow(score, schema)


def topic_words(terms: DataFrame, vocabulary: DataFrame, k: int, n: int = 15) -> DataFrame:
    """``(topic, position, index, term)``: each topic's first terms by weight, looked up by their index.

    ``vocabulary``: index, term.  A topic is described by term indices, as a fitted model is; a join gives their words.
    """
    weights = terms.join(vocabulary, "term").select("index", F.posexplode("beta").alias("topic", "beta"))
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("beta"), "index"))
    # A limit of the plain row number also applies before the shuffle to the few topics.
    first = weights.withColumn("_place", place).filter(F.col("_place") <= n).withColumn("position", F.col("_place") - 1)
    described = first.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("position", "index"))).alias("indices"))
    return described.select("topic", F.inline("indices")).join(vocabulary, "index").select("topic", "position", "index", "term")


def label_of_topic(topic: Column, labels: dict[int, str], unknown: str = "Unknown") -> Column:
    """The label of a topic number from a small map."""
    by_topic = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(by_topic, topic), F.lit(unknown))


# --- the model ----------------------------------------------------------------------

@dataclass
class TopicResult:
    """Scored news, counts per district, model metrics and one row per topic."""

    scored: DataFrame
    counts: DataFrame
    metrics: DataFrame
    topics: DataFrame
    model: LDAModel | None = None
    features: DataFrame | None = None

    def release(self) -> None:
        """Free the cached features once the results are written."""
        if self.features is not None:
            self.features.unpersist()


def _empty(news: DataFrame, place: str, key: str) -> TopicResult:
    spark = news.sparkSession
    scored = news.withColumns({"dominant_topic": F.lit(None).cast("int"), "kategori_ml": F.lit(None).cast("string")})
    counts = news_counts(scored, place, "kategori_ml", key).limit(0)
    metrics = spark.createDataFrame([], "metric string, value double")
    return TopicResult(scored, counts, metrics, spark.createDataFrame(
        [], "topic int, terms array<string>, kategori_ml string"))


def topic_counts(news: DataFrame, id_col: str = "id_berita", text_cols=("judul", "deskripsi_mentah"),
                 place: str = "kecamatan_terdeteksi", key: str = KEY, stopwords=fixed.TOPIC_STOPWORDS,
                 keywords: dict[str, list[str]] | None = None, k: int = 2, max_iter: int = 10,
                 seed: int = 42, vocab_size: int = 5000, min_df: float = 2.0, max_terms: int = 15,
                 subsampling: float = 0.05,
                 unknown: str | None = "unknown", partitions: int | None = None,
                 strict: bool = False) -> TopicResult | None:
    """Fit LDA on news with a known place and count the news per district and topic label.

    The rows are placed by the hash of their id into a fixed number of partitions and
    sorted there, so that the seed gives the same model whatever the input layout; keep
    ``partitions`` fixed to compare runs.  Only the vocabulary (at most ``vocab_size``
    words) and the topic terms come to the driver.  Each iteration of the online fit sees the
    share ``subsampling`` of the texts, as the estimator's default has it.  Without news the counts are empty;
    ``strict`` returns None instead.
    """
    spark = news.sparkSession
    known = news if unknown is None else news.filter(F.col(place) != unknown)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = (known.select(id_col, place, document_text(*text_cols).alias("_text"))
            .repartition(partitions, id_col).sortWithinPartitions(id_col))
    words = Tokenizer(inputCol="_text", outputCol="_words").transform(docs)
    words = StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=list(stopwords)).transform(words)
    # The texts are read once; from here on the token lists are used.
    words = words.select(id_col, place, "_kept").persist(StorageLevel.MEMORY_AND_DISK)
    if words.isEmpty():
        words.unpersist()
        return None if strict else _empty(known, place, key)

    # Equal counts are ordered by the word, which the estimator leaves open; the model's
    # random start depends on that order.
    min_docs = min_df if min_df >= 1 else min_df * words.count()
    vocabulary = [row.term for row in term_table(words, "_kept", min_docs, vocab_size).collect()]
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_kept", outputCol="_counts").transform(words)
    weights = IDF(inputCol="_counts", outputCol="features").fit(counted)
    features = weights.transform(counted).select(id_col, place, "features").persist(StorageLevel.MEMORY_AND_DISK)
    model = LDA(k=k, maxIter=max_iter, seed=seed, subsamplingRate=subsampling, featuresCol="features").fit(features)
    # The perplexity bound is the likelihood per unit of term weight, so one pass over the
    # corpus serves both figures.
    likelihood = float(model.logLikelihood(features))
    weight = features.select(Summarizer.normL1(F.col("features")).alias("w")).first().w.values.sum()
    metrics = spark.createDataFrame(
        [("log_likelihood", likelihood), ("log_perplexity", float(-likelihood / weight))], "metric string, value double")
    words.unpersist()

    listed = [(row.topic, [vocabulary[i] for i in row.termIndices])
              for row in model.describeTopics(max_terms).collect()]
    topics = (spark.createDataFrame(listed, "topic int, terms array<string>")
              .withColumn("kategori_ml", keyword_label("terms", keywords)))
    labels = {row.topic: row.kategori_ml for row in topics.collect()}

    scored = model.transform(features).select(
        id_col, place, vector_to_array("topicDistribution").alias("topic_distribution"))
    scored = scored.withColumn("dominant_topic", dominant("topic_distribution"))
    scored = scored.withColumn("kategori_ml", label_of_topic(F.col("dominant_topic"), labels))
    return TopicResult(scored, news_counts(scored, place, "kategori_ml", key), metrics, topics, model, features)
