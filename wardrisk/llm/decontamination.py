"""Benchmark decontamination: windows of benchmark words that occur in training texts, in DataFrame functions only.

A benchmark item's windows are its runs of ten consecutive words; a shorter item is one window.  Every text is read
once: its words are hashed, hashes of windows are made by joining hashes of shorter runs (1, 2, 4, 8 words), so that a
window costs a few steps whatever its length, and each is looked up in a bit set of the benchmark's window hashes.
Places that pass keep their words in a table.  They are joined with the set of windows by hash and verified word by
word: equal hashes alone are no hit.  The window set is broadcast while it is small (``BROADCAST_BYTES``, measured
before), and shuffled by hash beyond; the bit set has at most ``MOST_LONGS`` numbers, and a benchmark too large for it
only lets more places through to the join.

Defined results: a null text has no words and no hits; letters other than A-Z keep their case; items of one id are one
item; a null item id counts as one item and is no part of the digest; repeated documents are judged each; an empty
benchmark hits nothing; an empty table gives no rows; columns other than those asked for are not read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WIDTH = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text as it was written.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The window set is broadcast up to this size; the bit set has so many 64-bit numbers at most, and so many bits a window.
BROADCAST_BYTES, MOST_LONGS, BITS_A_WINDOW = 32 << 20, 1 << 16, 64


def words_of(text: Column) -> Column:
    """The words of a text after lower-casing A-Z only."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def with_runs(rows: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``words_`` to columns ``run<length>``: a hash of the words from each place on; places too near the end have one of less.

    Each step is a column of its own that the next one reads twice, so no lambda computes it again.
    """
    powers = [1]
    while powers[-1] * 2 <= max(lengths, default=1):
        powers.append(powers[-1] * 2)
    rows = rows.withColumn("power1", F.transform("words_", lambda w: F.xxhash64(w)))

    def joined(first: str, second: str, shift: int) -> Column:
        rest = F.slice(second, shift + 1, F.greatest(F.size(second), F.lit(1)))
        return F.zip_with(first, rest, lambda a, b: F.xxhash64(a, b))

    for p in powers[1:]:
        rows = rows.withColumn(f"power{p}", joined(f"power{p // 2}", f"power{p // 2}", p // 2))
    made = {p: f"power{p}" for p in powers}
    for length in lengths:
        done = max(p for p in powers if p <= length)
        name = made[done]
        while done < length:
            step = max(p for p in powers if p <= length - done)
            name, done, before, at = f"sum{done + step}_{length}", done + step, name, done
            rows = rows.withColumn(name, joined(before, made[step], at))
        rows = rows.withColumn(f"run{length}", F.col(name))
    return rows


def windows(benchmark: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``(length, words, item_id)`` of the items' windows."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), words_of(F.col(f"`{text}`")).alias("words_"))
    items = items.withColumn("length", F.least(F.size("words_"), F.lit(width))).where("length > 0")
    starts = F.explode(F.sequence(F.lit(0), F.size("words_") - F.col("length"))).alias("at")
    return (items.select("item_id", "length", "words_", starts)
            .select("length", F.expr("slice(words_, at + 1, length)").alias("words"), "item_id").distinct())


def hashed(grams: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The distinct windows ``(length, words)`` with their hash ``gram``."""
    rows = with_runs(grams.select("length", F.col("words").alias("words_")).distinct(), lengths)
    gram = reduce(lambda a, b: F.coalesce(a, b), [F.when(F.col("length") == n, F.get(f"run{n}", F.lit(0))) for n in lengths])
    return rows.select("length", F.col("words_").alias("words"), gram.alias("gram"))


def slots(gram: Column, bits: int) -> list[Column]:
    """Two places of a hash in a set of ``bits`` (a power of two) bits."""
    low = gram.bitwiseAND(F.lit(bits - 1))
    return [low, F.shiftrightunsigned(gram, 32).bitwiseAND(F.lit(bits - 1))]


def bit_set(grams: DataFrame, n_windows: int) -> tuple[Column, int]:
    """The bit set of the windows' hashes as one literal array, and its number of bits."""
    longs = 64
    while longs < MOST_LONGS and longs * 64 < n_windows * BITS_A_WINDOW:
        longs *= 2
    places = grams.select(F.explode(F.array(*slots(F.col("gram"), longs * 64))).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    filled = places.groupBy(F.floor(F.col("slot") / 64).cast("int").alias("at")).agg(F.bit_or(one).alias("bits"))
    values = [0] * longs
    for row in filled.collect():  # at most ``longs`` rows
        values[row["at"]] = row["bits"]
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>"), longs * 64


def candidates(docs: DataFrame, grams: DataFrame, lengths: Sequence[int], columns: Sequence[str], text: str,
               n_windows: int) -> DataFrame:
    """One row per document: ``c0, c1, ...`` (its columns), ``row_``, ``n_words`` and ``places`` whose hash may be a window's."""
    bits, n_bits = bit_set(grams, n_windows)
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    kept = [f"c{i}" for i in range(len(columns))]
    rows = docs.select(*own, words_of(F.col(f"`{text}`")).alias("words_"))
    rows = with_runs(rows, lengths)

    def listed(gram: Column) -> Column:
        hits = [F.getbit(F.get(bits, F.shiftright(s, 6).cast("int")), s.bitwiseAND(F.lit(63)).cast("int")) == 1
                for s in slots(gram, n_bits)]
        return hits[0] & hits[1]

    def found(length: int) -> Column:
        def place(gram: Column, at: Column) -> Column:
            return F.when(listed(gram), F.struct(at.cast("int").alias("at"), F.lit(length).alias("length"), gram.alias("gram")))
        return F.array_compact(F.transform(f"run{length}", place))

    places = F.concat(*[found(n) for n in lengths]) if lengths else F.array().cast("array<struct<at:int,length:int,gram:bigint>>")
    rows = rows.select(*kept, "words_", F.size("words_").cast("long").alias("n_words"), places.alias("found_"))
    worded = F.transform(F.filter("found_", lambda p: p["at"] + p["length"] <= F.col("n_words")), lambda p: F.struct(
        p["at"].alias("at"), p["length"].alias("length"), p["gram"].alias("gram"),
        F.slice(F.col("words_"), p["at"] + 1, p["length"]).alias("words")))
    return stored(rows.select(*kept, F.monotonically_increasing_id().alias("row_"), "n_words", worded.alias("places")),
                  "window-places")


class Contamination:
    """The verified occurrences of a benchmark's windows in documents; computed once and stored."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, columns: Sequence[str] = ("doc_id",), text: str = "text",
                 width: int = WIDTH, item_id: str = "item_id", item_text: str = "text",
                 broadcast_bytes: int = BROADCAST_BYTES):
        self.columns = tuple(columns)
        listed = stored(windows(benchmark, width, item_id, item_text), "windows")
        lengths = sorted(r["length"] for r in listed.select("length").distinct().collect())  # at most ``width`` rows
        grams = stored(hashed(listed, lengths), "window-set") if lengths else listed.select("length", "words", F.lit(0).cast("long").alias("gram"))
        size = grams.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "words")) + 96).alias("bytes")).first()
        self.rows = candidates(docs, grams, lengths, self.columns, text, size["n"])
        asked = F.broadcast(grams) if (size["bytes"] or 0) <= broadcast_bytes else grams
        places = self.rows.select("row_", F.inline("places"))
        self.hits = stored(places.join(asked, ["gram", "length", "words"]).select("row_", "at", "length", "words"), "window-hits")
        self.items = self.hits.select("row_", "length", "words").distinct().join(listed, ["length", "words"]).select("row_", "item_id").distinct()

    def spans(self) -> DataFrame:
        """``row_`` and the first and one past the last word of each maximal run of hit words."""
        ends = self.hits.select("row_", F.col("at").alias("first"), (F.col("at") + F.col("length")).alias("last")).distinct()
        ordered = Window.partitionBy("row_").orderBy("first", "last")
        earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
        fresh = (F.col("first") > F.coalesce(F.max("last").over(earlier), F.lit(-1))).cast("int")
        run = ends.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        return run.groupBy("row_", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")

    def digests(self) -> DataFrame:
        """Per document its columns, words, hit words, items and whether it is contaminated."""
        hit = self.spans().groupBy("row_").agg(F.sum(F.col("last") - F.col("first")).cast("long").alias("n_hit"))
        ids = F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",")
        items = self.items.groupBy("row_").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(ids, 256).alias("items_sha256"))
        base = self.rows.select(*[f"c{i}" for i in range(len(self.columns))], "row_", "n_words")
        joined = base.join(hit.join(items, "row_"), "row_", "left")
        return joined.select(
            *[F.col(f"c{i}").alias(c) for i, c in enumerate(self.columns)], "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, columns: Sequence[str] = ("doc_id",), **options) -> DataFrame:
    """Per document its ``columns``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    return Contamination(docs, benchmark, columns, **options).digests()


def without_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "spans",
                          most_share: float = 1.0, **options) -> DataFrame:
    """The documents without what the benchmark has: all their columns, in their order.

    ``remove="documents"`` drops each document with a hit.  ``remove="spans"`` takes out runs of hit words, from the first
    letter of the first to the last letter of the last word, and drops documents of which more than ``most_share`` is hit.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove}")
    columns = tuple(docs.columns)
    found = Contamination(docs, benchmark, columns, text, **options)
    names = [f"c{i}" for i in range(len(columns))]
    if remove == "documents":
        return found.rows.join(found.hits.select("row_"), "row_", "left_anti").select(*names).toDF(*columns)
    runs = (found.spans().groupBy("row_").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"),
                                              F.sum(F.col("last") - F.col("first")).alias("n_hit")))
    own = f"c{columns.index(text)}"
    rows = found.rows.drop("places").join(runs, "row_", "left").where(
        F.col("n_hit").isNull() | (F.col("n_hit") <= F.col("n_words") * F.lit(most_share)))
    whole = F.col(own).cast("string")
    # Texts with hits only: what stands before, between and after the words, and the words as they were written.
    hit = F.col("n_hit").isNotNull()
    rows = (rows.withColumn("gaps", F.when(hit, F.split(whole, WORD))).withColumn("own", F.when(hit, F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)))))

    def stays(at: Column) -> Column:
        return ~F.exists("runs", lambda r: (r["first"] <= at) & (at < r["last"]))

    def inside(at: Column) -> Column:
        return F.exists("runs", lambda r: (r["first"] < at) & (at < r["last"]))

    words = F.transform("own", lambda w, i: F.when(stays(i), w).otherwise(F.lit("")))
    gaps = F.transform("gaps", lambda g, i: F.when(inside(i), F.lit("")).otherwise(g))
    cleaned = F.array_join(F.flatten(F.zip_with(gaps, words, lambda g, w: F.array(g, F.coalesce(w, F.lit(""))))), "")
    kind = docs.schema[text].dataType
    rows = rows.withColumn(own, F.when(hit, cleaned.cast(kind)).otherwise(F.col(own)))
    return rows.select(*names).toDF(*columns)
