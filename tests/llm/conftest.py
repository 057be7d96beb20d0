import random

import pytest

EDGES = [None, "", " \n\t ", "a", "word", "a b", "x" * 5000, "ab " * 3000, "Straße CAFÉ naïve", "日本語 テキスト",
         "line one\nline one\n\nline two\nline one", "<|endoftext|> and <|startoftext|>", "\x00\x01 control \x1c sign",
         "Κόσμος Σίσυφος İstanbul", "a b c"]


def prose(rng: random.Random, words: int) -> str:
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    made = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w.capitalize() + "." if i % 9 == 0 else w for i, w in enumerate(made))


@pytest.fixture(scope="session")
def corpus():
    """Rows (id, text): prose, exact and near copies, shared passages, junk and odd texts."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(5, 160)) for _ in range(60)]
    passage = prose(rng, 60)
    texts += [t for t in texts[:8]] + [t + " more" for t in texts[8:16]]
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(6)]
    texts += [" ".join(w for w in prose(rng, 12).split() for _ in range(12)) for _ in range(4)]
    texts += EDGES + ["Released under the MIT License.", "Apache License, Version 2.0; CC BY-NC 4.0 CC-BY-NC"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with further columns that are named like columns of results and working columns."""
    schema = ("doc_id long, text string, score double, kept boolean, part int, ord long, fp long, n_words string, "
              "component string, body binary, row long, key long, ids string")
    return spark.createDataFrame([(i, t) + (None,) * 11 for i, t in corpus], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
