"""Alignment of the tokens of two tokenizers, and how often their ids are linked.

Tokenizer A (byte-level BPE, a file of ranks) encodes a space and the text,
tokenizer B (pieces with byte fallback) the text, to which it adds the space itself.
Both then tile the same bytes, and the offsets where tokens of both end cut the
bytes into groups.

Groups come from pointer jumping: every token points to its farthest-right
overlapping token, of tokens with one end to B's; doubling all pointers at once
until none changes leads each token to the last token of its group, which labels it.

The tokens that end a group are linked. Where two tokens end together the shorter is
a suffix of the longer, so the number of id pairs that can be linked is bounded by
the vocabularies alone (``pair_bound``): the table of counts is broadcast whatever
the size of the corpus. Texts are encoded once: ids go to the scratch folder packed,
two bytes an id where the vocabulary allows, with one bit a token for group ends.

Defined results: a text that is NULL, empty, no valid UTF-8, or that a tokenizer
does not give back byte for byte has no tokens; names of special tokens inside texts
are plain text; ids of documents are handed through, so NULL, repeated ids and
repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import as_bytes, columns, keyed_schema, written
from reviewloom.llm.tokens import vocabulary_path

A_RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json
B_MODEL = "piece_bpe_32k.model"
GROUP_BYTES = 2_000_000  # of texts aligned together
TOKENS = 1_000_000  # unpacked together
SPACE = "▁"


class _Side:
    """``pieces`` are the bytes of every id, ``dtype`` what holds an id."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pa.array(pieces, pa.binary())
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.dtype = np.dtype("<u2") if len(pieces) <= 1 << 16 else np.dtype("<u4")

    def joined(self, ids: np.ndarray) -> memoryview:
        """The bytes of all ids, one after the other."""
        data = self.pieces.take(pa.array(ids)).buffers()[2]
        return memoryview(data if data is not None else b"").cast("B")


class RankSide(_Side):
    def __init__(self, path: str):
        import public_tokenizers

        with open(path, "rb") as file:
            ranks = {base64.b64decode(t): int(rank) for t, rank in map(bytes.split, file)}
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        super().__init__(pieces)
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        encode = self._encoding.encode_ordinary
        return [np.array(encode(" " + text), self.dtype) for text in texts]


class PieceSide(_Side):
    def __init__(self, path: str):
        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        pieces = [name.replace(SPACE, " ").encode() for name in names]
        for i, name in enumerate(names):
            if model.is_byte(i):  # <0xHH>
                pieces[i] = bytes([int(name[3:5], 16)])
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._model.encode(texts, num_threads=1)
        return [np.array(ids, self.dtype) for ids in found]


@cache
def _sides(a_path: str, b_path: str) -> tuple[RankSide, PieceSide]:
    """One pair per worker process, kept between tasks."""
    return RankSide(a_path), PieceSide(b_path)


def pair_bound(a_path: str, b_path: str) -> int:
    """Id pairs that can ever be linked: one token's bytes end with the other's."""
    a, b = (side.pieces.to_pylist() for side in _sides(a_path, b_path))
    found = 0
    for longer, shorter, strict in ((a, b, 0), (b, a, 1)):
        known: dict[bytes, int] = {}
        for piece in shorter:
            known[piece] = known.get(piece, 0) + 1
        # Equal pieces are counted once, with the first of the two directions.
        found += sum(known.get(p[i:], 0) for p in longer for i in range(strict, len(p)))
    return found


def group_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which A and which B tokens end a group, from the byte offsets where tokens end.

    Both arrays rise strictly and have the same last value.
    """
    n = len(a_ends)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    # The B token that holds the last byte of an A token ends with it or behind it; the A
    # token that holds the last byte of a B token does too, and B goes first among equals.
    right_of_a = np.searchsorted(b_ends, a_ends)
    right_of_b = np.searchsorted(a_ends, b_ends)
    own = n + np.arange(len(b_ends))
    successor = np.concatenate(
        [n + right_of_a, np.where(a_ends[right_of_b] > b_ends, right_of_b, own)]
    )
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    a_label, b_label = successor[:n], successor[n:]
    return np.append(a_label[1:] != a_label[:-1], True), np.append(b_label[1:] != b_label[:-1], True)


def align_texts(texts: list[bytes | None], a: _Side, b: _Side) -> list[tuple | None]:
    """``(a_ids, a_last, b_ids, b_last)`` of each text; None where it has no tokens."""
    wanted = [i for i, text in enumerate(texts) if text]
    plain = [texts[i].decode("utf-8", "replace") for i in wanted]
    sides = []
    same = np.ones(len(wanted), bool)
    for side in (a, b):
        ids = side.encode(plain)
        flat = np.concatenate([*ids, np.zeros(0, side.dtype)])
        joined = side.joined(flat)
        ends = np.concatenate([[0], np.cumsum(side.sizes[flat])])
        at = ends[np.cumsum([0, *map(len, ids)])].tolist()
        for n, i in enumerate(wanted):
            view = joined[at[n] : at[n + 1]]
            same[n] &= len(view) == len(texts[i]) + 1 and view[:1] == b" " and view[1:] == texts[i]
        sides.append(ids)
    result: list[tuple | None] = [None] * len(texts)
    tiling = np.flatnonzero(same).tolist()
    if not tiling:
        return result
    # Texts lie one behind the other, so their borders are ends of tokens of both.
    ids = [[side[n] for n in tiling] for side in sides]
    ends = [np.cumsum(s.sizes[np.concatenate(own)]) for s, own in zip((a, b), ids)]
    a_last, b_last = group_ends(*ends)
    i = j = 0
    for n, a_ids, b_ids in zip(tiling, *ids):
        ni, nj = i + len(a_ids), j + len(b_ids)
        result[wanted[n]] = (a_ids, a_last[i:ni], b_ids, b_last[j:nj])
        i, j = ni, nj
    return result


PACKED = "n_a bigint, n_b bigint, a_ids binary, a_last binary, b_ids binary, b_last binary"


def align_tokenizers(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its tokens of both sides and where groups end.

    ``a_ids, b_ids``: ids, little-endian, packed. ``a_last, b_last``: one bit a token,
    the highest bit of a byte first, set on the last token of a group. ``groups``
    unpacks them to a row per group, ``unpack`` a batch to arrays.
    """
    paths = a_path or vocabulary_path(A_RANKS), b_path or vocabulary_path(B_MODEL)
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text")
    schema = keyed_schema(docs, PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(*paths)
        none = (np.zeros(0, a.dtype), np.zeros(0, bool), np.zeros(0, b.dtype), np.zeros(0, bool))
        for batch in batches:
            for part in _parts(batch, pc.binary_length(batch.column(1)), GROUP_BYTES):
                found = [x or none for x in align_texts(part.column(1).to_pylist(), a, b)]
                packed = [
                    [x[0].tobytes() for x in found], [np.packbits(x[1]).tobytes() for x in found],
                    [x[2].tobytes() for x in found], [np.packbits(x[3]).tobytes() for x in found],
                ]
                sizes = [pa.array([len(x[k]) for x in found], pa.int64()) for k in (0, 2)]
                arrays = [part.column(0), *sizes, *[pa.array(p, pa.binary()) for p in packed]]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, sizes: pa.Array, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most twice ``limit`` in size together, or a single larger one."""
    sizes = pc.fill_null(sizes, 0).to_numpy().astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit + np.cumsum(sizes > limit)
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def unpack(batch: pa.RecordBatch, a_path: str, b_path: str) -> dict[str, np.ndarray]:
    """All tokens of a batch of ``align_tokenizers``, document after document.

    ``a_ids, a_last, b_ids, b_last``: arrays over tokens; ``n_a, n_b``: over documents.
    """
    found = {}
    for name, side in zip("ab", _sides(a_path, b_path)):
        counts = batch.column(f"n_{name}").to_numpy()
        ids = b"".join(batch.column(f"{name}_ids").to_pylist())
        found[f"{name}_ids"] = np.frombuffer(ids, side.dtype)
        bits = np.unpackbits(np.frombuffer(b"".join(batch.column(f"{name}_last").to_pylist()), np.uint8))
        # Each document's bits fill whole bytes.
        taken = (counts + 7) // 8 * 8
        keep = np.repeat(np.tile([True, False], len(counts)), np.stack([counts, taken - counts], 1).ravel())
        found[f"{name}_last"] = bits[keep].astype(bool)
        found[f"n_{name}"] = counts
    return found


def map_tokens(
    aligned: DataFrame,
    schema: T.StructType | str,
    step: Callable[[pa.RecordBatch, dict[str, np.ndarray]], pa.RecordBatch],
    a_path: str,
    b_path: str,
) -> DataFrame:
    """Apply ``step`` to some documents of ``align_tokenizers`` and their tokens at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, pc.add(batch.column("n_a"), batch.column("n_b")), TOKENS):
                yield step(part, unpack(part, a_path, b_path))

    return aligned.mapInArrow(run, schema)


def _links(tokens: dict[str, np.ndarray]) -> np.ndarray:
    """Linked ids as one number each: A's id in the high half, B's in the low one."""
    a = tokens["a_ids"][tokens["a_last"]].astype(np.int64)
    return a << 32 | tokens["b_ids"][tokens["b_last"]]


def link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a_id, b_id, links, best``: how often ids are linked in all documents.

    ``best``: no other id of A is linked to that id of B more often.
    """

    def count(batch: pa.RecordBatch, tokens: dict[str, np.ndarray]) -> pa.RecordBatch:
        pair, links = np.unique(_links(tokens), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(links)], ["pair", "links"])

    packed = aligned.drop("doc_id")
    partial = map_tokens(packed, "pair bigint, links bigint", count, a_path, b_path)
    counted = partial.groupBy("pair").agg(F.sum("links").alias("links")).select(
        F.shiftright("pair", 32).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"),
        "links",
    )
    highest = counted.groupBy("b_id").agg(F.max("links").alias("highest"))
    return counted.join(highest, "b_id").select(
        "a_id", "b_id", "links", (F.col("links") == F.col("highest")).alias("best")
    )


class Links:
    """Counts of linked ids, to look up. Its size is bounded by ``pair_bound``."""

    def __init__(self, counts: pa.Table):
        pair = counts["a_id"].to_numpy().astype(np.int64) << 32 | counts["b_id"].to_numpy()
        order = np.argsort(pair)
        self.pair = pair[order]
        self.links = counts["links"].to_numpy()[order]
        self.best = counts["best"].to_numpy()[order]

    def of(self, tokens: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``links`` and ``best`` of every link of a batch."""
        at = np.searchsorted(self.pair, _links(tokens))
        return self.links[at], self.best[at]


def aligned_with_counts(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, Links]:
    """``align_tokenizers``, written, and the counts of all its links."""
    aligned = written(align_tokenizers(docs, a_path, b_path, id_col, text_col), "aligned")
    counts = written(link_counts(aligned, a_path, b_path), "link_counts")
    assert counts.count() <= pair_bound(a_path, b_path)
    return aligned, Links(counts.toArrow())


GROUPS = "group bigint, a_ids array<int>, b_ids array<int>, links bigint, best boolean"


def groups(aligned: DataFrame, links: Links, a_path: str, b_path: str) -> DataFrame:
    """A row per group: ``doc_id, group`` (from 0), the ids of both sides, how often its
    last ids are linked in all documents, and whether no other A id is more often."""
    known = aligned.sparkSession.sparkContext.broadcast(links)
    schema = keyed_schema(aligned, GROUPS)

    def step(batch: pa.RecordBatch, tokens: dict[str, np.ndarray]) -> pa.RecordBatch:
        count, best = known.value.of(tokens)
        lists = []
        for name in "ab":
            at = np.concatenate([[0], np.flatnonzero(tokens[f"{name}_last"]) + 1])
            values = pa.array(tokens[f"{name}_ids"].astype(np.int32))
            lists.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values))
        per_doc = groups_per_document(tokens)
        starts = np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(per_doc)), per_doc)))
        number = pa.array(np.arange(len(starts)) - starts)
        arrays = [ids, number, *lists, pa.array(count), pa.array(best)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_tokens(aligned, schema, step, a_path, b_path)


def groups_per_document(tokens: dict[str, np.ndarray]) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(tokens["a_last"])])
    return np.diff(ends[np.concatenate([[0], np.cumsum(tokens["n_a"])])])


@cache
def _spellings(size: int) -> pa.Array:
    """Every id in decimal with a comma behind it, then with a bar, then with a semicolon."""
    return pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(size)], pa.binary())


def spelled_groups(tokens: dict[str, np.ndarray]) -> list[bytes]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
    a_last, b_last = tokens["a_last"], tokens["b_last"]
    n_a, n_b = len(a_last), len(b_last)
    # A group's A tokens go before its B tokens: behind all tokens of earlier groups.
    b_until = np.concatenate([[0], np.flatnonzero(b_last) + 1])
    a_until = np.concatenate([[0], np.flatnonzero(a_last) + 1])
    a_place = np.arange(n_a) + b_until[np.cumsum(a_last) - a_last]
    b_place = np.arange(n_b) + a_until[np.cumsum(b_last) - b_last + 1] if n_b else np.zeros(0, int)
    sizes = [int(tokens[f"{x}_ids"].max()) + 1 if len(tokens[f"{x}_ids"]) else 1 for x in "ab"]
    size = 1 << max(16, (max(sizes) - 1).bit_length())
    names = _spellings(size)
    chosen = np.empty(n_a + n_b, np.int64)
    chosen[a_place] = tokens["a_ids"].astype(np.int64) + a_last * size
    chosen[b_place] = tokens["b_ids"].astype(np.int64) + b_last * (2 * size)
    taken = names.take(pa.array(chosen))
    widths = pc.binary_length(taken).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    data = taken.buffers()[2].to_pybytes() if n_a else b""
    at = ends[np.concatenate([[0], np.cumsum(tokens["n_a"] + tokens["n_b"])])].tolist()
    return [data[x : max(x, y - 1)] for x, y in zip(at, at[1:])]
