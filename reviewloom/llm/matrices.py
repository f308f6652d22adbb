"""Packed id matrices: best-fit-decreasing with a search tree over free capacity.

Documents longer than a row are split without loss. The pieces of a block go,
largest first, to the row with the least free room that still fits; a segment
tree over the amounts of free room finds it in a logarithm of the row length.

Blocks lie within one input partition and are bounded in tokens: no shuffle, and
memory does not depend on the data. Per block at most about one row is loose.

Defined results: a NULL or empty text is the end id alone; a NULL id is carried
through; repeated rows are documents of their own; equal sizes go by order of
input; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from reviewloom.llm.common import as_bytes, columns
from reviewloom.llm.tokens import encoder, token_blocks

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 2_000_000  # a bound on memory: some 500 rows at a time
ROW_GROUP_BYTES = 16 << 20


class FreeRoom:
    """Open rows by free room; ``fit`` finds the tightest that holds a size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)  # rows in each subtree
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, row: int, room: int) -> None:
        if room:
            self.rows[room].append(row)
            self._change(room, 1)

    def fit(self, size: int) -> tuple[int, int] | None:
        """Take out (row, room) with the least room of at least ``size``."""
        node = self.leaves + size
        if not self.count[node]:
            # Up to the first subtree on the right with a row, then down its left side.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Indexes of ``sizes``, none above ``capacity``, by row."""
    rows: list[list[int]] = []
    free = FreeRoom(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.fit(sizes[i])
        row, room = found or (len(rows), capacity)
        if not found:
            rows.append([])
        rows[row].append(i)
        free.add(row, room - sizes[i])
    return rows


def pack_matrices(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    pad_id: int = 0,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per matrix row.

    ``input_ids`` (little-endian ids, 2 or 4 bytes each by vocabulary, padded to
    ``capacity``), ``position_ids`` (likewise; from 0 again at every piece and in
    the padding), ``cu_seqlens`` (0, then the end of every piece), and per piece
    ``doc_ids`` and ``starts`` (the document's ids before it).
    """
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    arrow_id = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"""sequence_id bigint, n_tokens int, doc_ids array<{id_type}>, starts array<bigint>,
      cu_seqlens array<int>, input_ids binary, position_ids binary"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        dtype = encoder(tokenizer).dtype
        counter = np.arange(capacity, dtype=dtype)
        sequence = TaskContext.get().partitionId() << 33
        for block in token_blocks(batches, tokenizer, end_id, block_tokens):
            pieces = [
                (key, start, ids[start : start + capacity])
                for key, ids in block
                for start in range(0, len(ids), capacity)
            ]
            rows = []
            for members in best_fit([len(p[2]) for p in pieces], capacity):
                ids = np.full(capacity, pad_id, dtype)
                positions = np.zeros(capacity, dtype)
                ends = [0]
                for i in members:
                    part, at = pieces[i][2], ends[-1]
                    ends.append(at + len(part))
                    ids[at : ends[-1]] = part
                    positions[at : ends[-1]] = counter[: len(part)]
                positions[ends[-1] :] = counter[: capacity - ends[-1]]
                rows.append((sequence, ends[-1], [pieces[i][0] for i in members],
                             [pieces[i][1] for i in members], ends, ids.tobytes(),
                             positions.tobytes()))
                sequence += 1
            types = [pa.int64(), pa.int32(), pa.list_(arrow_id), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.binary(), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=NAMES)

    return docs.mapInArrow(run, schema)


NAMES = "sequence_id n_tokens doc_ids starts cu_seqlens input_ids position_ids".split()


def write_matrices(packed: DataFrame, path: str) -> None:
    """The rows as Parquet without compression: ids lie in the files as they are, to be
    mapped into memory by whoever reads them. Row groups are small, as a task holds one
    beside the block it packs."""
    options = {"compression": "none", "parquet.block.size": ROW_GROUP_BYTES}
    packed.write.mode("overwrite").options(**options).parquet(path)
