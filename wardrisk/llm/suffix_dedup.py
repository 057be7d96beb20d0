"""Removal of passages that occur earlier in the corpus, with suffix arrays over shared neighbourhoods.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document of
smaller id, or earlier in the same one.  Sorting every suffix of a corpus in one place cannot scale,
so suffixes meet by content: each window of ``length`` bytes belongs to its minimizer, the least hash
among its strings of ``GRAM`` bytes (leftmost of equals).  Equal windows have equal minimizers, and
consecutive windows with one minimizer occurrence form a piece, some 35 windows on average.

1. Every document is cut into pieces; equal pieces seen in one task are reduced to the earliest.
2. Pieces meet by minimizer.  Of equal pieces all but the earliest are removed.  A minimizer with one
   distinct piece is done; distinct pieces of one minimizer may still share windows.
3. Those fetch their bytes.  Per minimizer, a suffix array by two-stage sorting and its adjacent
   common prefixes give the runs of windows that agree over ``length`` bytes; all but the earliest go.
   Minimizers with more bytes than a task should sort send their windows one by one, keyed by content.

Defined results: a null text is empty; texts under ``length`` bytes stay whole; null ids come after
all others; rows with one id are ordered by the checksum of their text, and repeated rows (same id
and text) are one document that each of them shows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import slices, stored
from .suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 100, 32
#: Bytes that are cut into pieces at a time; a longer document is cut in several overlapping parts.
BUFFER_BITS = 18
#: Pieces of a task among which equal ones are reduced before they are sent.
REDUCE_ROWS = 1_500_000
#: Bytes of pieces that one suffix array holds, and from which a minimizer's windows are sent one by one.
ARRAY_BYTES, LARGE_BYTES = 1 << 20, 1 << 23

PIECE = "key long, content long, ord long, tie long, start long, n int"
_BYTE_HASHES = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)
_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM (a power of two) bytes from each position that has as many."""
    hashes, width = _BYTE_HASHES[data], 1
    factor = _ODD
    while width < GRAM:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        factor, width = factor * factor % 2 ** 64, 2 * width
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def cut_into_pieces(data: bytes, valid: np.ndarray, length: int):
    """(key, content, start, windows) of the pieces of a buffer; ``valid`` marks the windows inside one document."""
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    low = np.uint64((1 << BUFFER_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # equal hashes: the leftmost is least
    grams, width = length - GRAM + 1, 1
    while 2 * width <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if grams > width:
        least = np.minimum(least[:width - grams], least[grams - width:])
    windows = np.flatnonzero(valid)
    at = (least[windows] & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    starts, sizes = windows[first], np.diff(np.append(first, len(windows)))
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(data[a:b]) for a, b in zip(starts.tolist(), (starts + sizes + length - 1).tolist())),
                          dtype=np.uint64, count=len(starts))
    return hashes[at[first]].view(np.int64), content.view(np.int64), starts, sizes


def buffers_of(batch: pa.RecordBatch, length: int):
    """Documents of a batch, joined up to the size of a buffer: bytes, valid windows, rows and where each begins."""
    limit = 1 << BUFFER_BITS
    parts, rows, offsets, shifts, used = [], [], [], [], 0
    for row, text in enumerate(batch.column("body").to_pylist()):
        data = text or b""
        for begin in range(0, max(len(data) - length + 1, 0), limit - length + 1):
            part = data[begin:begin + limit]
            if used + len(part) > limit:
                yield b"".join(parts), rows, offsets, shifts
                parts, rows, offsets, shifts, used = [], [], [], [], 0
            parts.append(part)
            rows.append(row)
            offsets.append(used)
            shifts.append(begin)
            used += len(part)
    if parts:
        yield b"".join(parts), rows, offsets, shifts


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans per document, overlapping and touching ones made one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    reach = np.empty_like(end)
    bounds = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    high = int(end.max()) + 1
    numbers = np.cumsum(np.append(True, doc[1:] != doc[:-1])) - 1
    reach = np.maximum.accumulate(end + numbers * high) - numbers * high
    new = np.append(True, start[1:] > reach[:-1])
    new[bounds] = True
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.append(first[1:] - 1, len(doc) - 1)]


def rows_batch(key, content, order, tie, start, n) -> pa.RecordBatch:
    columns = [key, content, order, tie, start]
    arrays = [pa.array(np.asarray(c), pa.int64()) if c is not None else pa.nulls(len(start), pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(np.asarray(n), pa.int32())],
                                      ["key", "content", "ord", "tie", "start", "n"])


def document_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents, and rows without content: spans (start, n bytes) known to go."""
    held, count = [], 0

    def reduced():
        key, content, order, tie, start, n = (np.concatenate(c) for c in zip(*held))
        by = np.lexsort((key, content))  # equal pieces have equal keys: 128 bits tell pieces apart here as well
        same = (content[by][1:] == content[by][:-1]) & (key[by][1:] == key[by][:-1])
        group = np.cumsum(np.append(True, ~same))
        several = np.append(same, False) | np.append(False, same)
        places = by[several]
        own = np.lexsort((start[places], tie[places], order[places], group[several]))
        places, groups = places[own], group[several][own]
        later, own_first = places, places
        if len(places):
            new = np.append(True, groups[1:] != groups[:-1])
            own_first = places[np.flatnonzero(new)[np.cumsum(new) - 1]][~new]
            later = places[~new]
        keep = np.ones(len(key), dtype=bool)
        keep[later] = False
        later = later[~((order[later] == order[own_first]) & (tie[later] == tie[own_first])
                        & (start[later] == start[own_first]))] if len(later) else later  # a repeated row is no copy
        yield rows_batch(*(c[keep] for c in (key, content, order, tie, start, n)))
        if len(later):
            docs, number = np.unique(np.stack([order[later], tie[later]]), axis=1, return_inverse=True)
            doc, begin, end = merged(number.reshape(-1), start[later], start[later] + n[later] + length - 1)
            yield rows_batch(begin + docs[0][doc] * 1_000_003, None, docs[0][doc], docs[1][doc], begin, end - begin)

    for batch in slices(batches):
        orders, ties = batch.column("ord").to_numpy(), batch.column("tie").to_numpy()
        for data, rows, offsets, shifts in buffers_of(batch, length):
            ends = [*offsets[1:], len(data)]
            valid = np.zeros(len(data) - length + 1, dtype=bool)
            for a, b in zip(offsets, ends):
                valid[a:b - length + 1] = True
            key, content, starts, sizes = cut_into_pieces(data, valid, length)
            part = np.searchsorted(offsets, starts, side="right") - 1
            row = np.array(rows)[part]
            held.append((key, content, orders[row], ties[row], starts - np.array(offsets)[part] + np.array(shifts)[part],
                         sizes))
            count += len(key)
            if count >= REDUCE_ROWS:
                yield from reduced()
                held, count = [], 0
    if held:
        yield from reduced()


def first_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to spans (no key) and the earliest of each distinct piece whose key has others (with its key)."""
    last, place = None, np.full((3, 1), -1)  # the key and content before this batch, and where its first piece is
    waiting = None  # a first piece whose follower is not known
    for batch in batches:
        spans = batch.column("content").is_null().to_numpy(zero_copy_only=False)
        if spans.any():
            known = batch.filter(pa.array(spans))
            yield rows_batch(None, None, *(known.column(c).to_numpy() for c in ("ord", "tie", "start", "n")))
            batch = batch.filter(pa.array(~spans))
        if not batch.num_rows:
            continue
        key, content, order, tie, start, n = (batch.column(i).to_numpy() for i in range(6))
        first = np.append((key[0], content[0]) != last, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
        last = (key[-1], content[-1])
        places = np.stack([order, tie, start])
        firsts = np.concatenate([place, places[:, first]], axis=1)[:, np.cumsum(first)]  # each row's first piece
        place = firsts[:, -1:]
        later = ~first & (places != firsts).any(axis=0)  # a repeated row is at the same place as the first
        if later.any():
            yield rows_batch(None, None, order[later], tie[later], start[later], n[later] + length - 1)
        if not first.any():
            continue
        own = [c[first] for c in (key, order, tie, start, n)]
        if waiting is not None:
            own = [np.append(w, c) for w, c in zip(waiting[0], own)]
        same = own[0][1:] == own[0][:-1]
        shared = np.append(waiting is not None and waiting[1], same) | np.append(same, False)
        waiting = [c[-1:] for c in own], bool(shared[-1])
        own, shared = [c[:-1] for c in own], shared[:-1]
        if shared.any():
            key, order, tie, start, n = (c[shared] for c in own)
            yield rows_batch(key, None, order, tie, start, n)
    if waiting is not None and waiting[1]:
        key, order, tie, start, n = waiting[0]
        yield rows_batch(key, None, order, tie, start, n)


def repeated_windows(pieces: list[bytes], length: int) -> np.ndarray:
    """For pieces in corpus order, the windows that an earlier window equals, as places in the joined bytes."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    window = np.ones(len(text), dtype=bool)
    ends = np.cumsum(sizes)
    for back in range(1, length):
        window[ends - back] = False
    order = suffix_array(text, length)
    order = order[window[order]]
    run = np.cumsum(common_prefixes(text, order, length) < length)
    earliest = np.minimum.reduceat(order, np.flatnonzero(np.append(True, run[1:] != run[:-1])))
    return order[order != earliest[run - 1]]


def compare_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Distinct pieces sorted by key, bytes and place to the spans that go."""
    rows, size, last_key, last_body = [], 0, None, None

    def spans():
        rows.sort(key=lambda r: r[:3])
        bodies = [r[3] for r in rows]
        begins = np.cumsum([0] + [len(b) for b in bodies])
        found = np.sort(repeated_windows(bodies, length))
        if len(found):
            piece = np.searchsorted(begins, found, side="right") - 1
            piece, start, end = merged(piece, found - begins[piece], found - begins[piece] + length)
            order, tie, shift = (np.array([rows[i][k] for i in piece], dtype=np.int64) for k in range(3))
            yield rows_batch(None, None, order, tie, start + shift, end - start)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "ord", "tie", "start", "body")]
        copies = []
        for key, order, tie, start, body in zip(*columns):
            if key == last_key and body == last_body:  # sorted: an earlier piece has just these bytes
                copies.append((order, tie, start, len(body)))
                continue
            if key != last_key and size >= ARRAY_BYTES:
                yield from spans()
                rows, size = [], 0
            rows.append((order, tie, start, body))
            size += len(body)
            last_key, last_body = key, body
        if copies:
            yield rows_batch(None, None, *(np.array(c, dtype=np.int64) for c in zip(*copies)))
    if rows:
        yield from spans()


def with_place(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents with their place in the corpus: ``ord`` and ``tie``; ``body`` has the bytes.

    ``ord`` is the id, or 62 bits of its hash if ids are no whole numbers; ``tie`` are 64 bits of the text's hash.  Null
    ids come after all others (below 2**62) and have 62 further bits of the text's hash there.  None of the three can be
    null, also by their types, so that no join adds a filter of its own to the documents.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string").cast("binary"), F.lit(b""))
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    last = F.shiftrightunsigned(F.xxhash64(F.lit("null"), body), 2) + F.lit(2 ** 62)
    place = (F.coalesce(F.col(f"`{doc_id}`").cast("long"), last) if whole else
             F.when(F.col(f"`{doc_id}`").isNull(), last).otherwise(F.shiftrightunsigned(F.xxhash64(f"`{doc_id}`"), 2)))
    return docs.withColumns({"ord": place, "tie": F.xxhash64(body), "body": body})


def repeated_spans(placed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows ``(ord, tie, start, n)`` for documents of :func:`with_place`: bytes that go; spans may overlap.

    The texts are dealt out by (ord, tie) with all columns of ``placed``: a later join of it on these columns has the same
    exchange, so that Spark moves the texts once for both.
    """
    pieces = placed.select("ord", "tie", "body").mapInArrow(lambda b: document_pieces(b, length), PIECE)
    met = (pieces.repartition("key").sortWithinPartitions("key", "content", "ord", "tie", "start")
           .mapInArrow(lambda b: first_pieces(b, length), PIECE))
    marks = stored(met.drop("content"), "marks")
    shared = marks.where("key IS NOT NULL")
    large = (shared.groupBy("key").agg(F.sum(F.col("n") + length - 1).alias("bytes"))
             .where(F.col("bytes") > LARGE_BYTES).select("key", F.lit(True).alias("large")))
    wanted = (shared.join(large, "key", "left").groupBy("ord", "tie")
              .agg(F.collect_list(F.struct("key", "start", "n", F.coalesce("large", F.lit(False)).alias("large")))
                   .alias("pieces")))  # at most one piece for each byte of the document

    def with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = []
            for order, tie, body, own in zip(*(batch.column(c).to_pylist() for c in ("ord", "tie", "body", "pieces"))):
                for p in own:
                    start, key = p["start"], p["key"]
                    if p["large"]:
                        for at in range(start, start + p["n"]):
                            window = body[at:at + length]
                            rows.append((xxhash.xxh64_intdigest(window) - 2 ** 63, order, tie, at, window))
                    else:
                        rows.append((key, order, tie, start, body[start:start + p["n"] + length - 1]))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["key", "ord", "tie", "start", "body"])

    texts = placed.join(wanted, ["ord", "tie"]).dropDuplicates(["ord", "tie"])
    compared = (texts.mapInArrow(with_bytes, "key long, ord long, tie long, start long, body binary")
                .repartition("key").sortWithinPartitions("key", "body", "ord", "tie", "start")
                .mapInArrow(lambda b: compare_pieces(b, length), PIECE))
    known = marks.where("key IS NULL").select("ord", "tie", "start", "n")
    return known.unionByName(compared.select("ord", "tie", "start", "n"))


def remaining(body: bytes, spans: list) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many went, and in how many maximal runs."""
    if not spans:
        return body, 0, 0
    start = np.array([s["start"] for s in spans])
    _, start, end = merged(np.zeros(len(start), dtype=np.int64), start, start + np.array([s["n"] for s in spans]))
    kept = b"".join(body[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(body)]))
    return kept, int((end - start).sum()), len(start)


def without_repeats(docs: DataFrame, columns: tuple[str, ...], doc_id: str = "doc_id", text: str = "text",
                    length: int = LENGTH) -> DataFrame:
    """``columns`` of every row, with n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    ``kept_text`` has the remaining bytes without characters that lost a part of their bytes.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    carried = [c for c in columns if c not in results]
    placed = with_place(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)],
                                    F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")), "_id", "_text").drop("_id", "_text")
    spans = (repeated_spans(placed, length).distinct().groupBy("ord", "tie")
             .agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    joined = placed.join(spans, ["ord", "tie"], "left").select(
        *[f"c{i}" for i in range(len(carried))], "body", "spans")

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for body, own in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
                kept, removed, runs = remaining(body, own)
                rows.append((len(body), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(carried)] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], carried + results)

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried]
                       + ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", "kept_text string"])
    return joined.mapInArrow(finished, schema)
