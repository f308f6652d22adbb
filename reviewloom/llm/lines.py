"""Line deduplication with two Bloom filters.

Pass one puts the key of every line into a filter of keys seen once; a key that
is there already also goes into a filter of keys seen twice. Tasks send the bit
positions they set, by segment of the filter; whoever merges a segment puts a
position that was set before into the second filter. A key in two documents is
therefore always in the second filter.

Pass two tests every line against the second filter. Only suspects are counted,
by a 128-bit digest of the key, combined per batch and per task before they
move: that is the exact confirmation. Pass three drops lines: all of a confirmed
key, or all but its first (``keep_first``), which is chosen among confirmed lines alone.

The filter's size follows the number of lines up to ``max_bits``, the proven
bound of what is broadcast. Beyond that it only lets more suspects through;
results stay exact. Confirmed keys are broadcast up to ``broadcast_keys`` and
joined by document beyond.

Defined results: a NULL or empty text is one empty line, whose key has no code
points and is never dropped; each row is a document, repeated rows included; ids
may be NULL; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import as_bytes, columns, join_counted, keyed_schema, map_batches, written

SPACE = b" \t\n\x0b\f\r"
MIN_DOCS = 10
SEGMENT_BITS = 1 << 20
MAX_BITS = 1 << 29  # 64 MB
BITS_PER_LINE = 32  # rounded down to a power of two, so 16 at least
HASHES = 2
BROADCAST_KEYS = 500_000  # some 100 bytes each in a worker


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def document_digests(text: bytes | None) -> set[bytes]:
    """128-bit digests of the distinct keys of a text, the empty key left out."""
    keys = {line_key(line) for line in text.split(b"\n")} if text else set()
    keys.discard(b"")
    return {xxhash.xxh3_128_digest(k) for k in keys}


def _positions(digests: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of 16-byte digests, one row per hash; ``bits`` is a power of two."""
    halves = digests.view("<u8").reshape(-1, 2)
    return np.stack([halves[:, i % 2] >> np.uint64(8 * (i // 2)) for i in range(HASHES)]) & np.uint64(
        bits - 1
    )


def _as_array(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8)


def filter_bits(lines: int, max_bits: int = MAX_BITS) -> int:
    """A power of two, one segment at least."""
    wanted = min(max_bits, max(1, lines) * BITS_PER_LINE)
    return max(SEGMENT_BITS, 1 << math.floor(math.log2(wanted)))


def seen_twice(texts: DataFrame, bits: int) -> np.ndarray:
    """The second filter, as packed bits. ``texts`` has the column ``text``, as bytes."""

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents: Counter[bytes] = Counter()
            for text in batch.column(0):
                documents.update(document_digests(text.as_py()))
            if not documents:
                continue
            repeated = [d for d, n in documents.items() if n > 1]
            once = np.unique(_positions(_as_array(list(documents)), bits))
            twice = np.unique(_positions(_as_array(repeated), bits))
            segments = np.unique(once // SEGMENT_BITS)
            rows = [
                pa.array([_within(p, s) for s in segments], pa.binary()) for p in (once, twice)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(segments.astype(np.int32)), *rows], ["segment", "once", "twice"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by segment: one pair of filters is held at a time.
        current, once, twice = None, None, None
        for batch in batches:
            for segment, first, second in zip(*[c.to_pylist() for c in batch.columns]):
                if segment != current:
                    if current is not None:
                        yield _segment_row(current, twice)
                    current = segment
                    once = np.zeros(SEGMENT_BITS, bool)
                    twice = np.zeros(SEGMENT_BITS, bool)
                positions = np.frombuffer(first, "<u4")
                twice[positions[once[positions]]] = True
                once[positions] = True
                twice[np.frombuffer(second, "<u4")] = True
        if current is not None:
            yield _segment_row(current, twice)

    segments = (
        texts.mapInArrow(insert, "segment int, once binary, twice binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(merge, "segment int, bits binary")
    )
    found = np.zeros(bits // 8, np.uint8)
    width = SEGMENT_BITS // 8
    for row in segments.toLocalIterator():  # bits / 8 bytes in all
        found[row.segment * width : (row.segment + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return found


def _within(positions: np.ndarray, segment: int) -> bytes:
    low, high = np.searchsorted(positions, [segment * SEGMENT_BITS, (segment + 1) * SEGMENT_BITS])
    return (positions[low:high] - np.uint64(segment * SEGMENT_BITS)).astype("<u4").tobytes()


def _segment_row(segment: int, bits: np.ndarray) -> pa.RecordBatch:
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], ["segment", "bits"]
    )


def _suspected(digests: list[bytes], twice: np.ndarray, bits: int) -> np.ndarray:
    positions = _positions(_as_array(digests), bits)
    hit = (twice[positions >> np.uint64(3)] >> (positions & np.uint64(7)).astype(np.uint8)) & 1
    return hit.all(axis=0)


def repeated_keys(texts: DataFrame, min_docs: int, max_bits: int = MAX_BITS) -> DataFrame:
    """``digest, docs``: keys found in at least ``min_docs`` documents (2 or more)."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    # Counting newlines is cheap next to hashing lines.
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum(newlines + 1)).first()[0] or 0
    bits = filter_bits(lines, max_bits)
    raw = as_bytes(texts, "text")
    twice = texts.sparkSession.sparkContext.broadcast(seen_twice(raw, bits))

    def make():
        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            documents: Counter[bytes] = Counter()
            for text in batch.column(0):
                documents.update(document_digests(text.as_py()))
            digests = list(documents)
            if digests:
                hit = _suspected(digests, twice.value, bits)
                digests = [digests[i] for i in np.flatnonzero(hit)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array([documents[d] for d in digests], pa.int64()),
                ],
                ["digest", "docs"],
            )

        return count

    return (
        map_batches(raw, "digest binary, docs bigint", make, rows=None)
        .groupBy("digest")
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
    )


def _drop(text: bytes | None, repeated, first=frozenset()) -> tuple[int, int, bytes]:
    """Lines of ``repeated`` keys go, but the first of each key in ``first``."""
    lines = (text or b"").split(b"\n")
    kept, stay = [], set(first)
    for line in lines:
        key = line_key(line)
        digest = xxhash.xxh3_128_digest(key)
        if not key or digest not in repeated:
            kept.append(line)
        elif digest in stay:
            stay.remove(digest)
            kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


# Kept text leaves Python as bytes: it need not be valid UTF-8.
RESULT = "n_lines bigint, n_dropped bigint, kept binary"


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    max_bits: int = MAX_BITS,
    broadcast_keys: int = BROADCAST_KEYS,
    keep_first: bool = False,
) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_dropped, kept``.

    Lines whose key (stripped of white space, A-Z lower-cased) occurs in
    ``min_docs`` documents go, in every document; the others stay as they are.

    With ``keep_first`` the first line of each such key stays: that of the document with
    the smallest id (NULL before all others), of equal ids that of the first row as they
    were read, and in it the line that comes first. Ids need an order then.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    keys = written(repeated_keys(docs.select("text"), min_docs, max_bits), "line_keys")
    few = keys.count() <= broadcast_keys
    if few and not keep_first:
        rows = docs
    else:
        numbered = docs.withColumn("row", F.monotonically_increasing_id())
        rows = written(numbered, "line_docs")
    known = frozenset(keys.select("digest").toArrow().column(0).to_pylist()) if few else None
    sent = docs.sparkSession.sparkContext.broadcast(known)
    if known is None or keep_first:
        # Each document brings home its repeated keys, or those it is the first to have.
        pairs = _confirmed(rows, keys, sent)
        if keep_first:
            pairs = _with_first(pairs, rows)
            pairs = pairs.where("first") if few else pairs
        else:
            pairs = pairs.withColumn("first", F.lit(False))
        own = pairs.groupBy("row").agg(
            F.collect_list("digest").alias("repeated"),
            F.expr("collect_list(digest) FILTER (WHERE first)").alias("first"),
        )
        rows = rows.join(own, "row", "left").select("doc_id", "text", "repeated", "first")

    def make():
        everywhere = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            repeated, first = [everywhere] * len(texts), [()] * len(texts)
            if batch.num_columns > 2:
                first = [x or () for x in batch.column("first").to_pylist()]
                if everywhere is None:
                    repeated = [frozenset(x or ()) for x in batch.column("repeated").to_pylist()]
            found = [_drop(*row) for row in zip(texts, repeated, first)]
            arrays = [
                pa.array(values, kind)
                for values, kind in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary()))
            ]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema.names)

        return step

    schema = keyed_schema(docs, RESULT)
    dropped = map_batches(as_bytes(rows, "text"), schema, make)
    return dropped.withColumn("kept", F.col("kept").cast("string"))


def _confirmed(rows: DataFrame, keys: DataFrame, sent) -> DataFrame:
    """``row, digest``: the repeated keys of each document. ``sent`` holds the keys, or
    None where there are too many: digests are shuffled to meet them then."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            found = [document_digests(t.as_py()) for t in batch.column(1)]
            if known is not None:
                found = [d & known for d in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sorted(d) for d in found], pa.list_(pa.binary()))],
                ["row", "digests"],
            )

    pairs = (
        as_bytes(rows.select("row", "text"), "text")
        .mapInArrow(digests, "row bigint, digests array<binary>")
        .select("row", F.explode("digests").alias("digest"))
    )
    if sent.value is not None:
        return pairs
    return join_counted(written(pairs, "line_digests"), keys, "digest", "docs", "inner")


def _with_first(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``row, digest, first``: whether the row is the first that has the digest.

    Ranks of rows by (id, row) are 8 bytes, so minima combine in a hash aggregate before
    they move.
    """
    ranks = written(
        rows.select("doc_id", "row")
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("row", F.monotonically_increasing_id().alias("rank")),
        "line_ranks",
    )
    ranked = written(pairs.join(ranks, "row"), "line_pairs")
    least = ranked.groupBy("digest").agg(F.min("rank").alias("least"), F.count("*").alias("docs"))
    met = join_counted(ranked, written(least, "line_firsts"), "digest", "docs", "inner")
    return met.select("row", "digest", (F.col("rank") == F.col("least")).alias("first"))
