import math
import random

from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from wardrisk.functions import fixed
from wardrisk.operators import topics

CRIME = "polisi begal pelaku korban ditangkap maling pidana"
HEALTH = "pasien dbd wabah rsud puskesmas nyamuk infeksi"


def news(spark, copies=20):
    words = {"c": CRIME.split(), "h": HEALTH.split()}
    data = []
    for i in range(copies):
        for kind, listed in words.items():
            body = " ".join(listed[(i + k) % len(listed)] for k in range(12))
            data.append((f"{kind}{i:03d}", f"Berita {kind} surabaya", body, "Tandes" if i % 2 else "Pakal"))
    data.append(("u1", "polisi", "begal", "unknown"))
    return spark.createDataFrame(data, "id_berita string, judul string, deskripsi_mentah string, kecamatan_terdeteksi string")


def test_tokens_match_the_ml_tokenizer(spark):
    texts = ["Polisi, tangkap  pelaku ", " awal", "", " ", "a\tb\n", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ml = Tokenizer(inputCol="text", outputCol="w").transform(df).collect()
    assert [r.w for r in ml] == [r.w for r in df.select(topics.tokens(F.col("text")).alias("w")).collect()]


def test_vocabulary_and_weights_match_the_ml_estimators(spark):
    df = news(spark).withColumn("text", F.concat_ws(" ", "judul", "deskripsi_mentah"))
    words = StopWordsRemover(inputCol="a", outputCol="words", stopWords=fixed.TOPIC_STOPWORDS).transform(
        Tokenizer(inputCol="text", outputCol="a").transform(df))
    own = words.select("id_berita", topics.without_stopwords(topics.tokens(F.col("text"))).alias("own"), "words")
    assert own.filter("own <> words").count() == 0
    cv = CountVectorizer(inputCol="words", outputCol="n", vocabSize=5000, minDF=2.0).fit(words)
    assert {r.term for r in topics.term_table(words, "words").collect()} == set(cv.vocabulary)
    idf = IDF(inputCol="n", outputCol="f").fit(cv.transform(words))
    weights = dict(zip(cv.vocabulary, idf.idf.toArray()))
    for r in topics.term_weights(words, "id_berita", "words").collect():
        assert abs(r.weight - r.n * weights[r.term]) < 1e-9


def test_labels_and_dominant(spark):
    label = spark.range(1).select(
        topics.keyword_label(F.array(*map(F.lit, ["polisi", "pasien"]))).alias("tie"),
        topics.keyword_label(F.array(*map(F.lit, ["dbd", "pasien", "polisi"]))).alias("health"),
        topics.dominant(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("d")).first()
    assert (label.tie, label.health, label.d) == ("Kriminalitas", "Kesehatan", 1)


def test_topic_counts_repeatable_whatever_the_layout(spark):
    df = news(spark)
    first = topics.topic_counts(df, partitions=4)
    second = topics.topic_counts(df.repartition(3).orderBy(F.rand(1)), partitions=4)
    for part in ("scored", "counts"):
        a, b = (sorted(map(str, getattr(r, part).drop("topic_distribution").collect())) for r in (first, second))
        assert a == b
    metrics = [{r.metric: r.value for r in x.metrics.collect()} for x in (first, second)]
    assert abs(metrics[0]["log_likelihood"] - metrics[1]["log_likelihood"]) < 1e-6
    assert set(metrics[0]) == {"log_likelihood", "log_perplexity"}
    labels = {r.id_berita[0]: r.kategori_ml for r in first.scored.collect()}
    assert len(first.scored.collect()) == 40 and set(labels) == {"c", "h"}
    counts = first.counts.agg(F.sum(F.col("total_kasus_berita_kriminal") + F.col("total_kasus_berita_wabah"))).first()[0]
    assert counts == 40


def test_perplexity_is_likelihood_per_weight(spark):
    result = topics.topic_counts(news(spark), partitions=4)
    values = {r.metric: r.value for r in result.metrics.collect()}
    assert values["log_perplexity"] > 0 and values["log_likelihood"] < 0


def test_empty_corpus(spark):
    unknown = news(spark).filter("kecamatan_terdeteksi = 'unknown'")
    assert topics.topic_counts(unknown, strict=True) is None
    result = topics.topic_counts(unknown)
    assert result.counts.count() == 0
    assert result.counts.columns == ["kecamatan", "total_kasus_berita_kriminal", "total_kasus_berita_wabah"]


def test_both_topics_with_one_label(spark):
    same = {"Kriminalitas": ["polisi"], "Kesehatan": ["none"]}
    result = topics.topic_counts(news(spark), keywords=same, partitions=2)
    row = result.counts.agg(F.sum("total_kasus_berita_kriminal"), F.sum("total_kasus_berita_wabah")).first()
    assert tuple(row) == (40, 0)


def plain_inference(words, k, alpha, rounds):
    """The E-step of one text in plain Python; ``words`` are (n, beta)."""
    def psi(x):
        total = 0.0
        while x < 30:
            total -= 1 / x
            x += 1
        return total + math.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6)

    gamma = [alpha + sum(n for n, _ in words) / k] * k
    for _ in range(rounds + 1):
        logs = [psi(g) - psi(sum(gamma)) for g in gamma]
        e = [math.exp(x) for x in logs]
        last = gamma
        gamma = [alpha + e[i] * sum(n * b[i] / sum(x * y for x, y in zip(e, b)) for n, b in words) for i in range(k)]
    gamma = last
    bound = sum(n * math.log(sum(x * y for x, y in zip(e, b))) for n, b in words)
    bound += sum((alpha - g) * x + math.lgamma(g) - math.lgamma(alpha) for g, x in zip(gamma, logs))
    return [g / sum(gamma) for g in gamma], bound + math.lgamma(k * alpha) - math.lgamma(sum(gamma))


def test_inference_is_the_e_step(spark):
    draw = random.Random(5)
    beta = {f"t{i}": [draw.random() + 0.01 for _ in range(3)] for i in range(12)}
    texts = {d: {f"t{draw.randrange(14)}": draw.randint(1, 9) for _ in range(draw.randint(1, 8))} for d in range(25)}
    counts = spark.createDataFrame([(d, t, n) for d, found in texts.items() for t, n in found.items()], "d int, term string, n long")
    terms = spark.createDataFrame(list(beta.items()), "term string, beta array<double>")
    for rounds in (0, 1, 12):
        got = {r.d: r for r in topics.infer_topics(counts, terms, "d", 3, alpha=0.2, rounds=rounds).collect()}
        known = {d: [(n, beta[t]) for t, n in found.items() if t in beta] for d, found in texts.items()}
        assert set(got) == {d for d, words in known.items() if words}
        for d, r in got.items():
            weights, bound = plain_inference(known[d], 3, 0.2, rounds)
            assert max(abs(a - b) for a, b in zip(r.topic_distribution, weights)) < 1e-7 and abs(r.bound - bound) < 1e-6
            assert r.weight == sum(n for n, _ in known[d])


def test_gamma_functions(spark):
    values = [0.05, 0.25, 1.0, 2.0, 7.5, 1000.0]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", topics.log_gamma(F.col("x")).alias("g"), topics.digamma(F.col("x")).alias("p")).collect()
    for r in rows:
        assert abs(r.g - math.lgamma(r.x)) < 1e-8
        step = r.x * 1e-5
        assert abs(r.p - (math.lgamma(r.x + step) - math.lgamma(r.x - step)) / (2 * step)) < 1e-5 * max(1, abs(r.p))
    assert abs(rows[2].p + 0.5772156649) < 1e-8


def test_topic_terms_and_labels(spark):
    counts = spark.createDataFrame([(0, "a", 3), (0, "b", 1), (1, "b", 4)], "topic int, term string, n long")
    terms = topics.topic_terms(counts, "topic", "term", "n", 3, smoothing=1.0)
    assert {r.term: r.beta for r in terms.collect()} == {"a": [4 / 6, 1 / 6, 1 / 2], "b": [2 / 6, 5 / 6, 1 / 2]}
    vocabulary = spark.createDataFrame([(0, "b"), (1, "a")], "index long, term string")
    words = topics.topic_words(terms, vocabulary, 3, n=1)
    assert sorted((r["topic"], r["position"], r["index"], r["term"]) for r in words.collect()) == [(0, 0, 1, "a"), (1, 0, 0, "b"), (2, 0, 0, "b")]
    labelled = spark.range(3).select(topics.label_of_topic(F.col("id").cast("int"), {0: "x", 1: "y"}).alias("label"))
    assert [r.label for r in labelled.collect()] == ["x", "y", "Unknown"]
