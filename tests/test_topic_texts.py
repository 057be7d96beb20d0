"""The topics of the documents: what the queries move between tasks, and texts with odd keys."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import wardrisk.sources.writers as writers
from wardrisk.operators import topics
from wardrisk.plans import catalog

DOCS, WORDS = 300, 60


def write(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(4).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """300 documents of 60 words each, out of a vocabulary of 200: 18,000 pairs of a document and a term."""
    draw = random.Random(3)
    texts = [" ".join(draw.sample([f"w{j}" for j in range(200)], WORDS)) for _ in range(DOCS)]
    return write(spark, tmp_path_factory.mktemp("documents"), [(i, t, ["de", "en", "es", "fr"][i % 4], "s", len(t)) for i, t in enumerate(texts)])


def shuffled(df) -> int:
    """Records that the executed plan of the frame wrote to shuffles."""
    found, left = {}, [df._jdf.queryExecution().executedPlan()]
    while left:
        node, name = left[-1], left.pop().nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            left.append(node.plan())
        elif name == "ReusedExchange":
            left.append(node.child())
        elif name == "Exchange":
            written = node.metrics().apply("shuffleRecordsWritten")
            found[written.id()] = written.value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    assert found
    return sum(found.values())


def test_weights_move_texts_and_terms_of_blocks(spark, folder):
    df = catalog.QUERIES["topic_weights"](spark, folder)
    assert len(df.collect()) == DOCS
    assert shuffled(df) < DOCS * WORDS / 2


def test_texts_of_blocks_as_by_counts(spark):
    """Repeated and missing ids, texts without words, words that are no terms, and more texts than one slice counts."""
    draw = random.Random(7)
    beta = {f"t{i}": [draw.random() + 0.01 for _ in range(3)] for i in range(12)}
    ids = [*range(30), *range(10), None, None, 99, 100, 101]
    data = [(i, [f"t{draw.randrange(14)}" for _ in range(draw.randint(1, 9))]) for i in ids[:-3]] + [(99, []), (100, None), (101, ["none"])]
    texts = spark.createDataFrame(data, "d long, words array<string>").withColumn("block", F.pmod(F.hash("d"), F.lit(3)))
    terms = spark.createDataFrame([(b, t, x) for b in range(3) for t, x in beta.items()], "block int, term string, beta array<double>")
    counts = texts.select("d", F.explode("words").alias("term")).groupBy("d", "term").agg(F.count(F.lit(1)).alias("n"))
    right = {r.d: r for r in topics.infer_topics(counts, terms.filter("block = 0"), "d", 3, rounds=3).collect()}
    assert None in right and len(right) >= 30 and not {99, 100, 101} & set(right)
    got = topics.infer_texts(texts, terms, "d", "words", "block", 3, rounds=3).collect()
    assert len(got) == len(right) and {r.d for r in got} == set(right)
    for r in got:
        assert max(abs(a - b) for a, b in zip(r.topic_distribution, right[r.d].topic_distribution)) < 1e-12
        assert abs(r.bound - right[r.d].bound) < 1e-9 and r.weight == right[r.d].weight


def test_languages_that_are_no_topic(spark, tmp_path):
    """Their words are terms and their documents get weights, as in SQL; a missing language ended the query."""
    draw = random.Random(11)
    texts = [" ".join(draw.choices([f"w{j}" for j in range(30)], k=12)) for _ in range(40)] + [None, "", "once"]
    langs = ["de", "en", "es", "fr", None]
    path = write(spark, tmp_path, [(i, t, langs[i % 5], "s", 1) for i, t in enumerate(texts)])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    right = {r[0]: r[1:] for r in con.execute(catalog.ORACLES["topic_weights"]).fetchall()}
    got = {r[0]: r[1:] for r in catalog.QUERIES["topic_weights"](spark, path).collect()}
    assert set(got) == set(right) and len(got) == 40
    assert all(max(abs(a - b) for a, b in zip(got[i], right[i])) < 2e-3 for i in got)


def test_likelihood_moves_texts_and_terms_of_blocks(spark, folder):
    df = catalog.QUERIES["topic_likelihood"](spark, folder)
    assert df.collect()[0].log_perplexity > 0
    assert shuffled(df) < DOCS * WORDS / 2


def test_labels_move_terms_alone(spark, folder, monkeypatch):
    kept, keep = [], writers.checkpointed
    monkeypatch.setattr(writers, "checkpointed", lambda df: (kept.append(df), keep(df))[1])
    assert len(catalog.QUERIES["topic_labels"](spark, folder).collect()) == DOCS
    assert len(kept) == 1 and shuffled(kept[0]) < DOCS * WORDS / 2


def test_terms_of_two_texts(spark, tmp_path):
    """Rows with the same id and language are one text; with an id and without, or in two languages, they are two."""
    rows = [(1, "x once", "de"), (1, "x once", "de"), (2, "x two", "en"), (None, "two none", "en"), (None, "none", "en"), (3, "langs", "es"), (3, "langs", "fr"), (4, "x", None)]
    path = write(spark, tmp_path, [(i, t, lang, "s", 1) for i, t, lang in rows])
    words = {r.term for r in catalog.QUERIES["topic_terms"](spark, path).collect()}
    assert words == {"x", "two", "langs"}
    labels = catalog.QUERIES["topic_labels"](spark, path).collect()
    assert sorted((r.doc_id or 0, -1 if r.topic is None else r.topic, r.label) for r in labels if r.doc_id == 4) == [(4, -1, "Unknown")]
