"""Packing token ids into windows by Karmarkar-Karp multiway differencing.

Documents longer than a window are cut: all full windows first, one piece each,
then the rest. The rests are packed per block of consecutive documents. A block
starts with the fewest windows that could hold it. Differencing keeps partial
partitions, each a set of window loads; the two with the largest spread are
merged, heaviest loads with lightest, until one partition is left. Its windows
are nearly equal. If one exceeds the capacity, the block gets one window more.

A block is bounded in tokens and lies within one input partition, so nothing is
shuffled, memory does not depend on the data, and a lost task is run again with
the same result. Per block less than about one window stays empty.

Defined results: a NULL or empty text is the end id alone; a NULL id is carried
through; repeated rows are packed as documents of their own; ties in load go by
order of input; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from reviewloom.llm.common import as_bytes, columns, keyed_schema
from reviewloom.llm.tokens import token_blocks

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 1_000_000  # a bound on memory and on the work of differencing
LITTLE = 1.02  # more windows than this times the fewest possible: cut finer

PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of ``sizes`` dealt to ``windows`` windows with nearly equal sums.

    A partial partition is its loads in falling order; empty windows are left
    out. A load is (sum, node); a node is an index of ``sizes`` or a joint of two.
    """
    joints: list[tuple[int, int]] = []
    base = len(sizes)
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = base
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # Window i of the first meets window (windows - 1 - i) of the second.
        alone = max(0, windows - len(second))
        merged = first[:alone] + second[: max(0, windows - len(first))]
        for i in range(alone, len(first)):
            (a, x), (b, y) = first[i], second[windows - 1 - i]
            merged.append((a + b, base + len(joints)))
            joints.append((x, y))
        merged.sort(key=lambda load: -load[0])
        low = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (low - merged[0][0], serial, merged))
        serial += 1
    found = []
    for _, node in heap[0][2] if heap else []:
        stack, members = [node], []
        while stack:
            node = stack.pop()
            if node < base:
                members.append(node)
            else:
                stack.extend(joints[node - base])
        found.append(sorted(members))
    return found


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Indexes of ``sizes``, none above ``capacity``, by window."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, windows)
        if all(sum(sizes[i] for i in members) <= capacity for members in found):
            return found
        windows += max(1, windows // 200)


def cut(size: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of ``size``, all but the last ``limit`` long."""
    return [(start, min(limit, size - start)) for start in range(0, size, limit)]


def pack_rests(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (index, start, length).

    Sizes stay whole if little is left empty that way. Else, as with many sizes
    a little over half a window, they are cut into quarters, then sixteenths.
    """
    fewest = -(-sum(sizes) // capacity)
    for limit in (capacity, capacity // 4, capacity // 16):
        parts = [(i, *part) for i, size in enumerate(sizes) for part in cut(size, max(1, limit))]
        windows = pack([length for _, _, length in parts], capacity)
        if len(windows) <= max(fewest + 1, LITTLE * fewest):
            break
    return [[parts[i] for i in members] for members in windows]


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: whose ids, from where, in which sequence and at which offset.

    ``with_ids`` adds the piece's ids as ``ids array<int>``.
    """
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text")
    arrow_id = to_arrow_type(docs.schema["doc_id"].dataType)
    ddl = ", ".join([f"{name} bigint" for name in PIECE] + ["ids array<int>"] * with_ids)
    schema = keyed_schema(docs, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Sequences of a task are numbered from its partition's own range.
        sequence = TaskContext.get().partitionId() << 33
        for block in token_blocks(batches, tokenizer, end_id, block_tokens):
            rows, rests = [], []

            def add(key, ids: np.ndarray, start: int, length: int, offset: int) -> None:
                part = ids[start : start + length]
                digest = zlib.crc32(part.tobytes())
                rows.append((key, start, length, digest, len(ids), sequence, offset, part))

            for key, ids in block:
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    add(key, ids, start, capacity, 0)
                    sequence += 1
                if whole < len(ids):
                    rests.append((key, ids, whole))
            for window in pack_rests([len(ids) - at for _, ids, at in rests], capacity):
                offset = 0
                for i, start, length in window:
                    key, ids, at = rests[i]
                    add(key, ids, at + start, length, offset)
                    offset += length
                sequence += 1
            found = list(zip(*rows))
            arrays = [pa.array(found[0], arrow_id)]
            arrays += [pa.array(values, pa.int64()) for values in found[1:7]]
            if with_ids:
                arrays.append(pa.array([p.astype("<i4") for p in found[7]], pa.list_(pa.int32())))
            names = ["doc_id", *PIECE, *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(run, schema)
