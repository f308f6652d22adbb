"""Chat formatting at token level.

Each turn's text is encoded on its own and put between reserved ids, which no
text can yield; token and character offsets and the loss mask follow from prefix
sums over the conversation. In the text form control strings inside contents are
escaped: a backslash is doubled, and a control string gets a backslash after its
first character. That is undone by dropping each backslash before its neighbour.

Turns are spread by ranges of their order, so a conversation of any share of the rows is
sorted, encoded and formatted by many tasks. Offsets are summed in two steps: over a
conversation's turns in a task, and over the tasks it spans, a row each. Texts move
once; packed ids go to the scratch folder; masks and the text form are made from them
where they are needed.

Defined results: a NULL text or role is empty; turns go by (turn, role, text),
NULL first, so ties and repeated rows have an order and all stay; a NULL conv_id
is a conversation of its own; ids and turns may be of any type that can be sorted; a
role without marks of its own is spelled out; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reviewloom.llm.common import as_bytes, columns, written
from reviewloom.llm.tokens import vocabulary_path

TOKENIZER = "byte_bpe_50k.tiktoken"
# The template. Opening and closing mark of a turn, by role.
MARKS = {
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "system": ("<<SYS>>", "<</SYS>>"),
}
# Any other role: [ROLE] its name [/ROLE] text [/TURN]
ROLE, END_ROLE, END_TURN = "[ROLE]", "[/ROLE]", "[/TURN]"
CONTROL = [*[m for pair in MARKS.values() for m in pair], ROLE, END_ROLE, END_TURN]
LOSS_ROLE = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))  # no two of them overlap
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left in the result. ``unescape`` undoes it."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Codec:
    """Byte-level BPE of a file of ranks; reserved ids follow its vocabulary."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, "rb") as file:
            ranks = {base64.b64decode(t): int(rank) for t, rank in map(bytes.split, file)}
        self.size = max(ranks.values()) + 1
        self.reserved = {mark: self.size + i for i, mark in enumerate(CONTROL)}
        self.marks = {number: mark for mark, number in self.reserved.items()}
        pieces = [b""] * (self.size + len(CONTROL))
        for token, rank in ranks.items():
            pieces[rank] = token
        self._pieces = pa.array(pieces, pa.binary())
        spelled = [*pieces[: self.size], *[mark.encode() for mark in CONTROL]]
        self._spelled = pa.array(spelled, pa.binary())
        self.dtype = np.dtype("<u2") if len(pieces) <= 1 << 16 else np.dtype("<u4")
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        """Control strings and names of special tokens are text like any other."""
        return self._encoding.encode_ordinary(text)

    def decode(self, ids: pa.Array, at: np.ndarray, marks: bool = False) -> list[str]:
        """Text of ``ids[at[0]:at[1]]``, ``ids[at[1]:at[2]]`` and so on, with or without the
        control strings that reserved ids stand for."""
        taken = (self._spelled if marks else self._pieces).take(ids)
        sizes = pc.binary_length(taken).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[at].tolist()
        data = taken.buffers()[2].to_pybytes() if ends[-1] else b""
        return [data[a:b].decode() for a, b in zip(ends, ends[1:])]


@cache
def codec(path: str) -> Codec:
    """One per worker process, kept between tasks."""
    return Codec(path)


def reserved_ids(tokenizer: str) -> dict[str, int]:
    """Ids of the control strings: the first ones after the vocabulary."""
    return codec(tokenizer).reserved


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Ids as lists take much memory: few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


FORMATTED = """position bigint, ids array<int>, loss_mask array<boolean>, token_start bigint,
  char_start bigint, formatted string"""
_PLACED = """part int, position bigint, packed binary, head int, spoken boolean, token_start bigint,
  char_start bigint, tokens bigint, chars bigint"""


def _strings(column: pa.Array) -> list[str]:
    return [value.decode("utf-8", "replace") for value in column.to_pylist()]


def _turn_text(role: str, text: str) -> str:
    opening, end = MARKS.get(role) or (f"{ROLE}{escape(role)}{END_ROLE}", END_TURN)
    return opening + escape(text) + end


def format_turns(
    conversations: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn: ``conv_id, turn`` and ``position`` (from 0 in its conversation).

    ``ids`` with reserved ids, ``loss_mask`` (true on the text of the assistant),
    ``formatted`` text, and where both start in the conversation (``token_start``,
    ``char_start``). ``tokenizer`` is the path of a file of ranks.
    """
    tokenizer = tokenizer or vocabulary_path(TOKENIZER)
    turns = columns(
        conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col
    ).withColumns({name: F.coalesce(F.col(name), F.lit("")) for name in ("role", "text")})
    schema = T.StructType([*turns.schema.fields[:2], *T.StructType.fromDDL(_PLACED).fields])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = codec(tokenizer), TaskContext.get().partitionId()
        marks = known.reserved
        current, at = object(), (0, 0, 0)
        for batch in slices(batches):
            rows = []
            keys, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for key, role, text in zip(keys, roles, texts):
                role, text = role.decode("utf-8", "replace"), text.decode("utf-8", "replace")
                if role in MARKS:
                    head, end = [marks[MARKS[role][0]]], marks[MARKS[role][1]]
                else:
                    head = [marks[ROLE], *known.encode(escape(role)), marks[END_ROLE]]
                    end = marks[END_TURN]
                ids = [*head, *known.encode(escape(text)), end]
                if key != current:
                    current, at = key, (0, 0, 0)
                packed, chars = np.array(ids, known.dtype).tobytes(), len(_turn_text(role, text))
                rows.append(
                    (part, at[0], packed, len(head), role == LOSS_ROLE, *at[1:], len(ids), chars)
                )
                at = (at[0] + 1, at[1] + len(ids), at[2] + chars)
            kinds = [to_arrow_type(f.dataType) for f in schema.fields[2:]]
            made = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), *made], schema.names
            )

    order = ["conv_id", "turn", "role", "text", "copy"]
    sorted_turns = (
        turns.withColumn("copy", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("copy")
    )
    rows = written(as_bytes(sorted_turns, "role", "text").mapInArrow(placed, schema), "turns")
    # Where a conversation goes on in another task: what the tasks before have of it.
    sums = rows.groupBy("conv_id", "part").agg(
        F.count("*").alias("turns_before"),
        F.sum("tokens").alias("tokens_before"),
        F.sum("chars").alias("chars_before"),
    )
    names = ["turns_before", "tokens_before", "chars_before"]
    before = (
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sums.select(
        F.col("conv_id").alias("base_id"), F.col("part").alias("base_part"),
        *[F.sum(name).over(before).alias(name) for name in names],
    )
    bases = written(bases.where(F.col("turns_before").isNotNull()), "turn_offsets")
    same = F.col("conv_id").eqNullSafe(F.col("base_id")) & (F.col("part") == F.col("base_part"))
    starts = dict(zip(("position", "token_start", "char_start"), names))
    whole = rows.join(bases, same, "left").select(
        "conv_id", "turn", "packed", "head", "spoken",
        *[(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in starts.items()],
    )
    return _expanded(whole, tokenizer)


def _expanded(packed: DataFrame, tokenizer: str) -> DataFrame:
    """Ids, masks and the text form of packed turns."""
    schema = T.StructType([*packed.schema.fields[:2], *T.StructType.fromDDL(FORMATTED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(tokenizer)
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            parts = batch.column("packed").to_pylist()
            flat = np.frombuffer(b"".join(parts), known.dtype).astype(np.int32)
            sizes = [len(p) // known.dtype.itemsize for p in parts]
            ends = np.cumsum(sizes)
            # The mask is on behind the head and off before the closing mark.
            spoken = batch.column("spoken").to_numpy(zero_copy_only=False)
            turned = np.zeros(len(flat) + 1, np.int8)
            np.add.at(turned, (ends - sizes + np.asarray(batch.column("head")))[spoken], 1)
            np.add.at(turned, (ends - 1)[spoken], -1)
            mask = np.cumsum(turned[:-1]) > 0
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            formatted = known.decode(pa.array(flat), offsets.astype(np.int64), marks=True)
            made = {
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "loss_mask": pa.ListArray.from_arrays(pa.array(offsets), pa.array(mask)),
                "formatted": pa.array(formatted, pa.string()),
            }
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else batch.column(n) for n in schema.names], schema.names
            )

    return packed.mapInArrow(run, schema)


def read_turns(
    ids: pa.ListArray, loss_mask: pa.ListArray, tokenizer: str
) -> Iterator[tuple[str, str, str]]:
    """(role, text, text under the loss mask) of each turn, from its ids and mask alone."""
    known = codec(tokenizer)
    flat, mask = ids.flatten(), loss_mask.flatten()
    at = np.asarray(ids.offsets).astype(np.int64) - ids.offsets[0].as_py()
    numbers = flat.to_numpy()
    before = np.concatenate([[0], np.cumsum(mask.to_numpy(zero_copy_only=False))])
    learned = known.decode(flat.filter(mask), before[at].astype(np.int64))
    # Reserved ids have no text, so a role's name and the text need a border of their own.
    first, last = at[:-1], at[1:]
    body = first + 1
    named = np.flatnonzero(numbers[first] == known.reserved[ROLE])
    for i in named:
        body[i] += np.flatnonzero(numbers[first[i] : last[i]] == known.reserved[END_ROLE])[0]
    borders = np.append(np.stack([first, body], axis=1).ravel(), at[-1])
    texts = known.decode(flat, borders)
    roles = {known.reserved[begin]: role for role, (begin, _) in MARKS.items()}
    for i, mark in enumerate(numbers[first].tolist()):
        role = roles[mark] if mark in roles else unescape(texts[2 * i])
        yield role, unescape(texts[2 * i + 1]), unescape(learned[i])
