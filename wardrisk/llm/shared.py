"""Helpers that several operators use: folders, tables, vocabularies, texts in Arrow batches."""

from __future__ import annotations

import base64
import functools
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch that are held as Python objects at a time.
SLICE_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the session's warehouse where that is not set: both are shared."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of the frame, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Like cut(), as a compressed table of which later steps read only the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null is an empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def vocabulary_file(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def byte_encoder(path: str):
    """Byte-level encoder of a ``.tiktoken`` file; strings of special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


LATIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: The characters for which LATIN_PATTERN holds: ASCII without the four separators Python adds to \s, Latin letters,
#: and signs that are no letters, digits or spaces.
LATIN_TEXT = re.compile(f"[\x00-\x1b\x20-\x7f{LATIN_LETTERS}¡-©«-±´¶-¸»¿×÷‐-‧‰-⁞€]*")
#: The pattern of public_tokenizers.PATTERN for such texts.
LATIN_PATTERN = re.compile(rf" ?[{LATIN_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)"
                           rf"| ?[^\s0-9{LATIN_LETTERS}]+|\s+(?!\S)|\s+")


@functools.lru_cache(maxsize=1)
def any_pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def pre_tokens(text: str) -> list[str]:
    """The pieces of a text that byte-level BPE merges one by one."""
    if LATIN_TEXT.fullmatch(text):
        return LATIN_PATTERN.findall(text)
    return any_pattern().findall(text)


class Memo(dict):
    """Results of ``compute`` by text, remembered in two halves: when one is full the older one goes, so that what is asked
    for often stays."""

    HALF = 150_000

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def compute(self, text: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.compute(text)
        if len(text) <= 64:
            if len(self) >= self.HALF:
                self.older = dict(self)
                self.clear()
            self[text] = value
        return value


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceIds(Memo):
    """Ids of pieces as little-endian 32-bit numbers."""

    def __init__(self, encoder):
        super().__init__()
        self.single = encoder._core_bpe.encode_single_piece

    def compute(self, piece: str) -> bytes:
        return packed_ids(self.single(piece.encode()))


@functools.lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(byte_encoder(path))


def encode(known: PieceIds, text: str) -> np.ndarray:
    """Ids of a text; repeated pieces are merged once, and no pattern engine sees more than a piece at a time."""
    return np.frombuffer(b"".join(map(known.__getitem__, pre_tokens(text))), dtype="<u4")
