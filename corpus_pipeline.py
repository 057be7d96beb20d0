"""A corpus from raw documents to training sequences, in five stages.

Every stage takes the documents that its predecessor wrote and returns them without those it
rejects, or, the last one, the pieces of packed sequences.  Columns of the documents are carried by
position, so further columns may have any name.

Defined results: null texts are empty ones; documents with null or repeated ids stay apart, except
that rows equal in all columns are copies of one another; a document whose whole text repeats earlier
passages stays with an empty text; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardrisk.llm import packing, quality_model, quality_rules, shingle_copies, suffix_dedup
from wardrisk.llm.shared import read, stored


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns c0, c1, ... and where each named column went."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), {c: f"c{i}" for i, c in enumerate(docs.columns)}


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network scores at the threshold or above."""
    net = quality_model.fit(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    rows, at = numbered(docs)
    scored = quality_model.score(rows, net, "score", at["text"])
    return named(scored.where(F.col("score") >= quality_model.THRESHOLD), docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility band of their script."""
    rows, at = numbered(docs)
    judged = quality_rules.apply_rules(rows, tuple(rows.columns), text=at["text"])
    return named(judged.where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the least id (ties: the
    least hash of the row, of 128 bits)."""
    rows, at = numbered(docs)
    own = ("row1", "row2")
    rows = rows.withColumns({"row1": F.xxhash64(*rows.columns), "row2": F.xxhash64(F.lit("second"), *rows.columns)})
    ids = rows.select(*own, at["doc_id"]).distinct()
    found = shingle_copies.near_copies(rows, own, at["text"]).distinct().join(ids, list(own))
    first = F.min(F.struct(F.col(at["doc_id"]).isNull(), at["doc_id"], *own))
    keep = found.groupBy("component").agg(first.alias("first")).select("first.row1", "first.row2")
    return named(rows.join(keep, list(own), "left_semi").dropDuplicates(list(own)), docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document, or an earlier place in it, has."""
    rows, at = numbered(docs)
    others = tuple(c for c in rows.columns if c != at["text"])
    cleaned = suffix_dedup.without_repeats(rows, others, at["doc_id"], at["text"])
    cleaned = cleaned.withColumn(at["text"], F.col("kept_text"))
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn(at["n_chars"], F.length("kept_text").cast(kind))
    return named(cleaned, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of a fixed number of tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", classify_quality), ("quality rules", apply_quality_rules),
          ("SimHash near-dedup", drop_near_copies), ("suffix-array dedup", remove_repeated_passages),
          ("best-fit packing", pack_sequences)]

#: The classifier, the tokenisers and the suffix arrays are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage{number}")
    return docs
