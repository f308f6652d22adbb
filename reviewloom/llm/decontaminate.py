"""Find and remove benchmark passages with an FM-index per shard of documents.

Every run of ten words of a benchmark item (or the whole of a shorter one) is a
phrase. A shard is a block of a task's documents: their words, as numbers of the
benchmark's vocabulary. Stretches of known words shorter than the shortest
phrase cannot hold one and are left out, which is exact; the rest is indexed, all
phrases are searched backwards at once, occurrences are located by sampled
positions and merged to spans of words.

Distinct phrases are made by a Spark job over the benchmark and written. They are sent to
the tasks in blocks of about ``block_phrases``, one after the other: the driver and a
task hold one block at a time, and what was found with it is written before the next.
Documents are never shuffled.

Defined results: a NULL or empty text has no words; an item without words has no
phrase; an item without id goes by ''; repeated rows are documents of their own,
repeated items are one; a NULL doc_id is carried through; an empty table gives
no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import (
    alnum_words,
    as_bytes,
    columns,
    keyed_schema,
    map_batches,
    written,
)
from reviewloom.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1_000_000  # a bound on the index's memory, some 150 MB
BLOCK_PHRASES = 300_000  # some 40 MB as numbers, and their words

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


@dataclass
class Phrases:
    vocabulary: dict[bytes, int]  # from 1
    patterns: np.ndarray  # one row each, filled up with 0 on the left
    lengths: np.ndarray
    items: list[list[str]]  # whose each phrase is


def item_phrases(text: bytes | None, window: int = WINDOW) -> set[bytes]:
    """The distinct phrases of an item, words with a space between."""
    words = alnum_words(text)
    starts = range(max(1, len(words) - window + 1) if words else 0)
    return {b" ".join(words[at : at + window]) for at in starts}


def phrases(rows: list[tuple[str, bytes | None]], window: int = WINDOW) -> Phrases:
    """Of all items at once."""
    owners: dict[bytes, set[str]] = {}
    for item, text in rows:
        for phrase in item_phrases(text, window):
            owners.setdefault(phrase, set()).add(item)
    return numbered_phrases(list(owners), [sorted(o) for o in owners.values()], window)


def numbered_phrases(found: list[bytes], items: list[list[str]], window: int) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    patterns = np.zeros((len(found), window), np.int32)
    for row, phrase in enumerate(found):
        words = phrase.split(b" ")
        patterns[row, window - len(words) :] = [
            vocabulary.setdefault(w, len(vocabulary) + 1) for w in words
        ]
    return Phrases(vocabulary, patterns, (patterns > 0).sum(axis=1), items)


def distinct_phrases(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``phrase, items``: every phrase of the benchmark once, and whose it is, sorted."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [
                (phrase, item)
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for phrase in item_phrases(text, window)
            ]
            made, owners = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(made, pa.binary()), pa.array(owners, pa.string())], ["phrase", "item"]
            )

        return step

    pairs = map_batches(as_bytes(benchmark, "text"), "phrase binary, item string", make, rows=64)
    return pairs.groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Blocks:
    """The phrases of a benchmark, block by block."""

    def __init__(self, benchmark: DataFrame, block_phrases: int, window: int):
        self._table = written(distinct_phrases(benchmark, window), "phrases")
        self._window = window
        self.count = max(1, -(-self._table.count() // block_phrases))

    def broadcast(self, block: int) -> Broadcast:
        part = self._table.where(F.pmod(F.xxhash64("phrase"), F.lit(self.count)) == block)
        rows = part.toArrow()
        found, items = (rows.column(c).to_pylist() for c in ("phrase", "items"))
        known = numbered_phrases(found, items, self._window)
        return self._table.sparkSession.sparkContext.broadcast(known)


def _shard_hits(words: list[np.ndarray], known: Phrases) -> tuple[dict, dict]:
    """(document -> merged spans of words, document -> items) of one shard."""
    shortest = int(known.lengths.min())
    ids = np.concatenate([x for w in words for x in (w, np.zeros(1, np.int64))])
    document = np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])
    first = np.cumsum([0] + [len(w) + 1 for w in words])
    # Stretches of known words, each with the unknown one behind it.
    gaps = np.flatnonzero(ids == 0)
    starts = np.concatenate([[0], gaps[:-1] + 1])
    long = gaps - starts >= shortest
    starts, sizes = starts[long], gaps[long] - starts[long] + 1
    if not len(starts):
        return {}, {}
    into = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - into, sizes)
    index = FMIndex(ids[at])
    low, high = index.search(known.patterns, known.lengths)
    matched = np.flatnonzero(high > low)
    count = high[matched] - low[matched]
    phrase = np.repeat(matched, count)
    rows = np.arange(int(count.sum())) + np.repeat(low[matched] - (np.cumsum(count) - count), count)
    position = at[index.locate(rows)]
    # Words inside any occurrence.
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, position, 1)
    np.add.at(depth, position + known.lengths[phrase], -1)
    hit = np.cumsum(depth[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    spans: dict[int, list] = {}
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        doc = int(document[begin])
        spans.setdefault(doc, []).append((begin - int(first[doc]), end - int(first[doc])))
    items: dict[int, set] = {}
    pairs = np.unique(np.stack([document[position], phrase], axis=1), axis=0)
    for doc, number in pairs.tolist():
        items.setdefault(doc, set()).update(known.items[number])
    return spans, items


def search(texts: list[bytes | None], known: Phrases, shard_words: int = SHARD_WORDS):
    """Per text: its number of words, merged spans [start, end) of hit words, items."""
    number = known.vocabulary.get
    found: list[tuple[int, list, set]] = []
    shard: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if shard:
            spans, items = _shard_hits(shard, known) if len(known.lengths) else ({}, {})
            for i, words in enumerate(shard):
                found.append((len(words), spans.get(i, []), items.get(i, set())))
        shard.clear()
        held = 0

    for text in texts:
        words = alnum_words(text)
        shard.append(np.array([number(w, 0) for w in words], np.int64))
        held += len(words)
        if held >= shard_words:
            flush()
    flush()
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _benchmark(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = columns(benchmark, item_id=item_col, text=text_col)
    return items.withColumn("item_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")))


SPANS = "array<struct<start: bigint, end: bigint>>"


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items`` (sorted) and ``spans`` of hit words."""
    found = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text").select(
        "doc_id",
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr(f"CAST(array() AS {SPANS})").alias("spans"),
        F.expr("CAST(array() AS array<string>)").alias("items"),
    )
    schema = keyed_schema(found, f"text binary, n_words bigint, spans {SPANS}, items array<string>")
    blocks = _Blocks(_benchmark(benchmark, item_col, item_text_col), block_phrases, window)
    for block in range(blocks.count):
        sent = blocks.broadcast(block)

        def make(sent=sent):
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                hits = search(batch.column("text").to_pylist(), sent.value)
                spans, items = [], []
                earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                for (_, new, names), (old, old_names) in zip(hits, earlier):
                    old_spans = [(s["start"], s["end"]) for s in old]
                    both = _merged(new + old_spans)
                    spans.append([{"start": s, "end": e} for s, e in both])
                    items.append(sorted({*names, *old_names}))
                arrays = [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([h[0] for h in hits], pa.int64()),
                    pa.array(spans, batch.schema.field("spans").type),
                    pa.array(items, batch.schema.field("items").type),
                ]
                return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

            return step

        found = map_batches(found, schema, make, rows=None)
        if block + 1 < blocks.count:
            found = written(found, "searched")
            sent.destroy()
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = [m.span() for m in _WORD.finditer(text)]
    kept, position = [], 0
    for start, end in spans:
        kept.append(text[position : at[start][0]])
        position = at[end - 1][1]
    return b"".join([*kept, text[position:]])


def remove_from(texts: list[bytes | None], known: Phrases) -> tuple[list[bytes | None], list[int]]:
    """Texts without passages, and the number of words removed from each.

    A cut can bring the words of another phrase together, so what was cut is
    searched again until nothing is found.
    """
    texts, removed = list(texts), [0] * len(texts)
    rows = list(range(len(texts)))
    while rows:
        hits = search([texts[i] for i in rows], known)
        again = []
        for i, (_, spans, _) in zip(rows, hits):
            if spans:
                texts[i] = _without(texts[i], spans)
                removed[i] += sum(end - start for start, end in spans)
                again.append(i)
        rows = again
    return texts, removed


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """``doc_id, text, n_removed``: no phrase is left; clean texts stay as they are.

    A cut for one block of the benchmark may join words of another block's
    phrase, so several blocks are gone through until a round cuts nothing.
    """
    found = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text").withColumn(
        "n_removed", F.lit(0).cast("bigint")
    )
    schema = keyed_schema(found, "text binary, n_removed bigint")
    blocks = _Blocks(_benchmark(benchmark, item_col, item_text_col), block_phrases, window)

    def cut(block):
        def make():
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                texts, removed = remove_from(batch.column("text").to_pylist(), block.value)
                total = np.asarray(batch.column("n_removed")) + np.array(removed, np.int64)
                arrays = [batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(total)]
                return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_removed"])

            return step

        return make

    before, after = -1, 0
    while before < after:
        for block in range(blocks.count):
            sent = blocks.broadcast(block)
            found = map_batches(found, schema, cut(sent), rows=None)
            if blocks.count > 1:
                found = written(found, "decontaminated")
                sent.destroy()
        if blocks.count == 1:
            break
        before, after = after, found.agg(F.sum("n_removed")).first()[0] or 0
    return found.withColumn("text", F.col("text").cast("string"))
