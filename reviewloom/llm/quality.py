"""Quality rules: distance of a document's histograms from its language's.

Each text gets two histograms: classes of characters, and the common words of its
language against all other words. A language's reference is the mean over all its
documents that are long enough, so one long text counts as much as any other. A
document whose Jensen-Shannon distance from a reference is too great is rejected,
as is one that fails the base rules. Texts of fewer than ``MIN_WORDS`` words are
too short for either histogram and are judged by the base rules alone.

References are summed per batch and task in whole millionths, so they do not
depend on the order of rows; a language costs one row. Every value of the language
column has a reference of its own once ``MIN_DOCUMENTS`` long documents of it are there;
with fewer its documents are judged by the base rules alone. A language without a word
list here gets the words that most of its own long documents hold.

Defined results: a NULL or empty text has no words and fails the base rules; a
NULL or empty language has no reference, so the base rules alone judge; ids are
carried through; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import (
    UTF8_CONTINUATION,
    alnum_words,
    as_bytes,
    columns,
    keyed_schema,
    map_batches,
)

# Frequent function words.
COMMON = {
    "en": "the of and to a in is that it for was on with as be by this are at from",
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au",
    "de": "der die und in den von zu das mit sich des ein auf für ist im nicht dem eine als",
    "es": "de la que el en y los se del las un por con no su una para es al lo",
}
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MIN_DOCUMENTS = 20  # long ones of a language, for a reference
MAX_CHARACTER_DISTANCE = 0.25
# Few words scatter more: the limit is 0.25 + 1 / sqrt(words).
MAX_WORD_DISTANCE, WORD_SCATTER = 0.25, 1.0
BASE_WORDS = 10
BASE_REPEATED = 20  # per cent
WINDOW = 5

_SPACE = b" \t\n\x0b\f\r"
_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    _SPACE,
    b".,;:'\"?-()",
]
_OTHER_ASCII, _BEYOND_ASCII = len(_CLASSES), len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2
N_WORDS = 21  # twenty common words, all others
WIDTH = N_CLASSES + N_WORDS
_MILLION = 1_000_000


def _class_table() -> np.ndarray:
    table = np.full(256, _BEYOND_ASCII, np.int64)
    table[:128] = _OTHER_ASCII
    for number, members in enumerate(_CLASSES):
        table[list(members)] = number
    return table


_CLASS_OF = _class_table()
_LISTS = {lang: [w.encode() for w in words.split()] for lang, words in COMMON.items()}


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    word_chars = len(text.translate(None, UTF8_CONTINUATION + _SPACE))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(*[words[i:] for i in range(WINDOW)]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        covered = 0  # words before this one are counted
        for start, window in enumerate(windows):
            if window in often:
                repeated += start + WINDOW - max(covered, start)
                covered = start + WINDOW
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < BASE_WORDS or 100 * n_repeat_words > BASE_REPEATED * n_words


class Reference(NamedTuple):
    """Of one language: summed histograms and its common words."""

    sums: np.ndarray
    common: list[bytes]


def histograms(text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Characters by class; the common ``words`` and, last, all others."""
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    by_byte[0x80:0xC0] = 0  # a character beyond ASCII counts by its first byte
    characters = np.bincount(_CLASS_OF, weights=by_byte, minlength=N_CLASSES).astype(np.int64)
    counted = Counter(alnum_words(text))
    common = [counted[word] for word in words]
    by_word = np.zeros(N_WORDS, np.int64)
    by_word[: len(common)] = common
    by_word[-1] = counted.total() - sum(common)
    return characters, by_word


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence to base 2: from 0 to 1."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(
            q > 0, q * np.log2(q / middle), 0
        )
    return math.sqrt(max(0.0, float(terms.sum()) / 2))


def _millionths(counts: np.ndarray) -> np.ndarray:
    return counts * _MILLION // max(1, int(counts.sum()))


def _long_texts(batch: pa.RecordBatch, min_words: int):
    """Text and language of the rows that are long enough and have a language."""
    for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
        if lang:
            text = text.as_py() or b""
            if len(text.split(maxsplit=min_words)) >= min_words:
                yield text, lang


def _sums(docs: DataFrame, lists: dict[str, list[bytes]], min_words: int) -> DataFrame:
    """Per language its long documents, and their histograms by the words of ``lists``."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sums: dict[str, np.ndarray] = {}
            for text, lang in _long_texts(batch, min_words):
                both = [_millionths(h) for h in histograms(text, lists.get(lang, []))]
                sums[lang] = sums.get(lang, 0) + np.concatenate([[1], *both])
            totals = np.array(list(sums.values()), np.int64).reshape(-1, 1 + WIDTH)
            arrays = [pa.array(list(sums), pa.string()), *[pa.array(c) for c in totals.T]]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", *names])

        return step

    names = ["documents", *[f"h{i}" for i in range(WIDTH)]]
    schema = "lang string, " + ", ".join(f"{n} bigint" for n in names)
    sums = map_batches(docs, schema, make, rows=None)
    return sums.groupBy("lang").agg(*[F.sum(n).alias(n) for n in names])


def common_words(docs: DataFrame, min_words: int = MIN_WORDS) -> dict[str, list[bytes]]:
    """Per language the words that most of its long documents hold, ties by their bytes."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            held: Counter = Counter()
            for text, lang in _long_texts(batch, min_words):
                held.update((lang, word) for word in set(alnum_words(text)))
            arrays = [
                pa.array([lang for lang, _ in held], pa.string()),
                pa.array([word for _, word in held], pa.binary()),
                pa.array(held.values(), pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "documents"])

        return step

    held = map_batches(docs, "lang string, word binary, documents bigint", make, rows=None)
    held = held.groupBy("lang", "word").agg(F.sum("documents").alias("documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("documents"), "word")
    rows = held.withColumn("at", F.row_number().over(order)).where(F.col("at") < N_WORDS)
    lists: dict[str, list[bytes]] = {}
    for row in sorted(rows.collect(), key=lambda row: row["at"]):
        lists.setdefault(row.lang, []).append(bytes(row.word))
    return lists


def references(
    docs: DataFrame, min_words: int = MIN_WORDS, min_documents: int = MIN_DOCUMENTS
) -> dict[str, Reference]:
    """Per language its reference.

    ``docs`` has ``text`` as bytes and ``lang``. A row per language comes to the
    driver. Languages without a word list are read twice more, if there are any.
    """
    docs = docs.select("text", "lang")
    enough = F.col("documents") >= min_documents
    rows = _sums(docs, _LISTS, min_words).where(enough).collect()
    known = {row.lang: Reference(np.array(row[2:], np.int64), _LISTS.get(row.lang, [])) for row in rows}
    others = [lang for lang in known if lang not in COMMON]
    if others:
        docs = docs.where(F.col("lang").isin(*others))
        lists = common_words(docs, min_words)
        for row in _sums(docs, lists, min_words).collect():
            known[row.lang] = Reference(np.array(row[2:], np.int64), lists.get(row.lang, []))
    return known


def measure(text: bytes | None, lang: str | None, known: dict[str, Reference]) -> tuple:
    """Base counts, both distances (None without a reference or if too short) and both verdicts."""
    counts = base_counts(text)
    failed = base_failed(counts[0], counts[4])
    near, apart = None, None
    reference = known.get(lang)
    if counts[0] >= MIN_WORDS and reference is not None:
        characters, words = histograms(text, reference.common)
        near = js_distance(characters, reference.sums[:N_CLASSES])
        apart = js_distance(words, reference.sums[N_CLASSES:])
    far = near is not None and (
        near > MAX_CHARACTER_DISTANCE
        or apart > MAX_WORD_DISTANCE + WORD_SCATTER / math.sqrt(counts[0])
    )
    return (*counts, failed, near, apart, not failed and not far)


MEASURES = """n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,
  n_repeat_words bigint, base_failed boolean, character_distance double,
  word_distance double, kept boolean"""
_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    with_text: bool = False,
) -> DataFrame:
    """Per document its measures and ``kept``; ``with_text`` carries the text along."""
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col, lang=lang_col), "text")
    known = references(docs)
    schema = keyed_schema(docs, MEASURES + (", text binary" if with_text else ""))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            found = [measure(t.as_py(), lang, known) for t, lang in zip(texts, langs)]
            arrays = [batch.column("doc_id")]
            arrays += [pa.array(values, kind) for values, kind in zip(zip(*found), _TYPES)]
            return pa.RecordBatch.from_arrays(arrays + [texts] * with_text, names=names)

        return step

    names = schema.names
    judged = map_batches(docs, schema, make)
    return judged.withColumn("text", F.col("text").cast("string")) if with_text else judged
