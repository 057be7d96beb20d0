"""Training-order materialisation: fixed-length sequences in the order of a keyed permutation.

The documents' ids, each closed by an end id, form one stream in the order in which the table is
scanned; every ``size`` tokens are a sequence.  A keyed Feistel network with cycle-walking permutes
the sequence numbers, so every sequence has a global slot, and slots are cut into shards of a fixed
number.  A range of shards goes to one task, which writes each in slot order; tasks have SHARDS_A_TASK shards whatever the
corpus.  All records have the same number of bytes, so the place of any slot follows from its number: reading is
sequential, and can resume anywhere.

Defined results: a null or empty text is the end id alone; repeated rows are written each; the last
sequence is filled up with the end id, ``n_tokens`` counts its own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import encode, piece_ids, slices, stored, texts_of, vocabulary_file

VOCABULARY, END_ID = "byte_bpe_50k.tiktoken", 50256
SIZE, SHARD_ROWS, KEY, ROUNDS = 2048, 1024, 0x5EED, 6
#: Shards that one task writes, about 34 MB.
SHARDS_A_TASK = 8
#: Ends every record in a file; two bytes, so that 16-bit ids stay aligned.
RECORD_END = "\x00\n"


class Permutation:
    """Keyed permutation of 0 .. n-1: a balanced Feistel network on the next even number of bits, walked into range."""

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = np.random.default_rng(key).integers(0, 2 ** 63, rounds, dtype=np.uint64)

    def mix(self, half: np.ndarray, key: np.uint64) -> np.ndarray:
        x = half * np.uint64(0x9E3779B97F4A7C15) + key
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return (x ^ x >> np.uint64(31)) & self.mask

    def once(self, values: np.ndarray, backward: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = values >> half, values & self.mask
        for key in self.keys[::-1] if backward else self.keys:
            if backward:
                left, right = right ^ self.mix(left, key), left
            else:
                left, right = right, left ^ self.mix(right, key)
        return left << half | right

    def walk(self, values, backward: bool) -> np.ndarray:
        out = self.once(np.asarray(values, dtype=np.uint64), backward)
        while (outside := out >= self.n).any():
            out[outside] = self.once(out[outside], backward)
        return out.astype(np.int64)

    def slots(self, sequences) -> np.ndarray:
        return self.walk(sequences, False)

    def sequences(self, slots) -> np.ndarray:
        return self.walk(slots, True)


def encode_stream(docs: DataFrame, text: str, vocabulary: str, end_id: int) -> DataFrame:
    """Each document's 16-bit ids, with the task that encoded it and the tokens of that task before it."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, total = piece_ids(vocabulary_file(vocabulary)), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [np.append(encode(memo, x), np.uint32(end_id)).astype("<u2").tobytes() for x in texts_of(batch)]
            lengths = np.array([len(x) // 2 for x in ids])
            before = total + np.cumsum(lengths) - lengths
            total += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part), pa.int32()), pa.array(before, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())], ["part", "before", "n", "ids"])

    return (docs.select(F.col(f"`{text}`").cast("string").alias("text"))
            .mapInArrow(encoded, "part int, before long, n long, ids binary"))


def with_shape(docs: DataFrame, size: int, text: str, vocabulary: str, end_id: int) -> tuple[DataFrame, dict[int, int], int]:
    """The stored stream, the tokens before each task's part of it, and all its tokens."""
    stream = stored(encode_stream(docs, text, vocabulary, end_id), "ids", level=5)
    totals = sorted((r["part"], r["n"]) for r in stream.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts, total = {}, 0  # one row per task of the scan
    for part, n in totals:
        starts[part], total = total, total + n
    return stream, starts, total


def training_order(docs: DataFrame, key: int = KEY, size: int = SIZE, shard_rows: int = SHARD_ROWS, text: str = "text",
                   vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per slot: its shard and place in the shard's file, the sequence, its own tokens and all its ids.

    The vocabulary must have at most 65,536 ids.
    """
    return in_order(*with_shape(docs, size, text, vocabulary, end_id), key, size, shard_rows, end_id)


def in_order(stream: DataFrame, starts: dict[int, int], total: int, key: int, size: int, shard_rows: int, end_id: int) -> DataFrame:
    """The records of a stored stream, a range of shards in each partition and in the order of their slots there."""
    sequences = -(-total // size)
    order = Permutation(max(1, sequences), key)
    stride = 2 * size + len(RECORD_END)
    tasks = max(1, -(-sequences // (shard_rows * SHARDS_A_TASK)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("part", "before", "ids")]
            sequence, place, piece, end = [], [], [], -1
            for part, before, ids in zip(*columns):
                at, done = starts[part] + before, 0
                while done < len(ids) // 2:
                    room = min(size - (at + done) % size, len(ids) // 2 - done)
                    if at + done != end or end % size == 0:
                        sequence.append((at + done) // size)
                        place.append((at + done) % size)
                        piece.append([])
                    piece[-1].append(ids[2 * done:2 * (done + room)])  # neighbours in a sequence travel as one
                    done += room
                    end = at + done
            yield pa.RecordBatch.from_arrays(
                [pa.array(order.slots(sequence)), pa.array(place, pa.int32()),
                 pa.array([pack.compress(b"".join(x)) for x in piece], pa.binary())], ["slot", "place", "piece"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler, unpack = np.array([end_id], "<u2").tobytes(), zstandard.ZstdDecompressor().decompress

        def records(rows):
            slots = np.array([r[0] for r in rows], dtype=np.int64)
            ids = [b"".join(map(unpack, r[1])) for r in rows]
            lengths = [len(i) // 2 for i in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(slots // shard_rows), pa.array(slots % shard_rows * stride),
                 pa.array(order.sequences(slots)), pa.array(lengths, pa.int32()),
                 pa.array([i + filler * (size - n) for i, n in zip(ids, lengths)], pa.binary())],
                ["slot", "shard", "byte_offset", "sequence", "n_tokens", "ids"])

        rows: list[tuple] = []
        for batch in batches:
            for slot, piece in zip(*(batch.column(c).to_pylist() for c in ("slot", "piece"))):
                if rows and rows[-1][0] == slot:
                    rows[-1][1].append(piece)
                    continue
                if len(rows) >= 512:
                    yield records(rows)
                    rows = []
                rows.append((slot, [piece]))
        if rows:
            yield records(rows)

    pieces = stream.mapInArrow(dealt, "slot long, place int, piece binary")
    return (pieces.repartitionById(tasks, F.floor(F.col("slot") / (shard_rows * SHARDS_A_TASK)).cast("int"))
            .sortWithinPartitions("slot", "place")
            .mapInArrow(joined, "slot long, shard long, byte_offset long, sequence long, n_tokens int, ids binary"))


def materialise(docs: DataFrame, path: str, key: int = KEY, size: int = SIZE, shard_rows: int = SHARD_ROWS, text: str = "text",
                vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Write the shards to ``path/shards`` and what a reader has to know to ``path/shape``."""
    stream, starts, total = with_shape(docs, size, text, vocabulary, end_id)
    write_shards(in_order(stream, starts, total, key, size, shard_rows, end_id), f"{path}/shards")
    docs.sparkSession.createDataFrame([(total, key, size, shard_rows)], SHAPE).coalesce(1).write.parquet(f"{path}/shape")


SHAPE = "total long, key long, size int, shard_rows int"


def materialised(spark: SparkSession, path: str, from_slot: int = 0) -> DataFrame:
    """The records of the shards in ``path`` from a slot on, as :func:`training_order` has them; earlier shards are not opened."""
    shape = spark.read.schema(SHAPE).parquet(f"{path}/shape").first()
    total, size, shard_rows = shape["total"], shape["size"], shape["shard_rows"]
    sequences = -(-total // size)
    order, stride = Permutation(max(1, sequences), shape["key"]), 2 * size + len(RECORD_END)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            own = order.sequences(slots)
            tokens = np.where(own == sequences - 1, total - (sequences - 1) * size, size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(slots // shard_rows), pa.array(slots % shard_rows * stride), pa.array(own), pa.array(tokens),
                 batch.column("ids")], ["slot", "shard", "byte_offset", "sequence", "n_tokens", "ids"])

    return read_shards(spark, f"{path}/shards", size, shard_rows, from_slot).mapInArrow(
        described, "slot long, shard long, byte_offset long, sequence long, n_tokens int, ids binary")


def write_shards(records: DataFrame, path: str) -> None:
    """One file per shard in ``path/shard=<n>``: the ids of each slot and the record end, by Spark's own committer.

    The rows of a shard have to be in one partition.  They are sorted here, as the writer would sort by shard alone.
    """
    (records.sortWithinPartitions("shard", "slot").select("shard", F.col("ids").cast("string").alias("value"))
     .write.option("lineSep", RECORD_END).partitionBy("shard").text(path))


def read_shards(spark: SparkSession, path: str, size: int = SIZE, shard_rows: int = SHARD_ROWS,
                from_slot: int = 0) -> DataFrame:
    """Rows ``(slot, ids)`` from a slot on; earlier shards are not opened."""
    stride = 2 * size + len(RECORD_END)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            first, data = batch.column("shard")[0].as_py() * shard_rows, batch.column("content")[0].as_py()
            slots = range(max(first, from_slot), first + len(data) // stride)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()),
                 pa.array([data[(s - first) * stride:(s - first) * stride + 2 * size] for s in slots], pa.binary())],
                ["slot", "ids"])

    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:  # no shard was written
        return spark.createDataFrame([], "slot long, ids binary")
    files = files.where(F.col("shard") >= from_slot // shard_rows)
    return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(parsed, "slot long, ids binary")
