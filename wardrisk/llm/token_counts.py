"""Exact length histogram of a corpus in tokens, with suffix sums.

Documents are encoded once and counted by their length.  With the number of documents and tokens
at or above each length, any context limit c needs one row: the first with ``n_tokens >= c`` has
``truncated_total(c) = total_tokens - tokens_at_least + c * docs_at_least``.

Defined results: a null or empty text has 0 tokens; repeated rows count each; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import piece_ids, cut, encode, slices, texts_of, vocabulary_file

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Lengths per block of the suffix sums: a window sees one block, or one row per block.
BLOCK = 1024


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` per document."""
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = piece_ids(vocabulary_file(vocabulary))
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(encode(memo, x)) for x in texts_of(batch)], pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct length: its documents and tokens, the suffix sums and the share of documents up to it."""
    blocks = F.floor(F.col("n_tokens") / BLOCK).cast("long")
    counts = cut(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
                 .withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", blocks))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per_block = (counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
                 .select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
                         F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
                         F.sum("d").over(everything).alias("total_docs"),
                         F.sum("t").over(everything).alias("total_tokens")))
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = (counts.join(per_block, "block")
              .withColumn("docs_at_least", F.col("later_docs") + F.sum("n_docs").over(longer))
              .withColumn("tokens_at_least", F.col("later_tokens") + F.sum("tokens").over(longer)))
    return summed.select(
        "n_tokens", "n_docs", "tokens", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"))
        .alias("truncated_total"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("share_up_to"))


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """One row per context limit: documents cut by it, tokens kept and tokens lost; from the suffix sums."""
    whole = F.max("total_tokens")
    answers = []
    for limit in limits:
        at = F.min_by(F.struct("docs_at_least", "tokens_at_least"),
                      F.when(F.col("n_tokens") > limit, F.col("n_tokens")))
        over, beyond = F.coalesce(at["docs_at_least"], F.lit(0)), F.coalesce(at["tokens_at_least"], F.lit(0))
        kept = F.coalesce(whole, F.lit(0)) - beyond + F.lit(int(limit)) * over
        answers.append(F.struct(F.lit(int(limit)).alias("context"), over.alias("docs_cut"), kept.alias("tokens_kept"),
                                (beyond - F.lit(int(limit)) * over).alias("tokens_lost")))
    return histogram.agg(F.array(*answers).alias("x")).select(F.inline("x"))


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row per share: the smallest length that at least that share of the documents does not exceed."""
    answers = [F.struct(F.lit(float(q)).alias("share"),
                        F.min(F.when(F.col("share_up_to") >= float(q), F.col("n_tokens"))).alias("n_tokens"))
               for q in shares]
    return histogram.agg(F.array(*answers).alias("x")).select(F.inline("x"))
