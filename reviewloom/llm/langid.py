"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of -1 and 1, drawn from its code point. An n-gram
is bound from its letters: each letter's vector is permuted (rotated) once per place
behind it, and the permuted vectors are multiplied. A text is the bundle, the sum, of its
n-grams; a language the bundle of its texts, all of one weight whatever their length. The
language whose prototype has the highest cosine with a text is predicted.

N-grams are a letter and its two neighbours. Letters are what Unicode calls letters, in
lower case; anything else is a border, and so are both ends of a text.

Bundles are linear, so texts of a task are bundled before anything is shuffled: per
language and task one vector moves. All sums are of whole numbers, so results do not
depend on partitioning. Prototypes are broadcast ``BLOCK`` languages at a time, some 16 MB
at the default dimension.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every
text if nothing was learned; of equal cosines the smallest language wins; invalid UTF-8
is read with replacement characters, which are no letters; rows with a NULL language
teach nothing; ids are handed through, so NULL, repeated ids and repeated rows stay; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import as_bytes, columns, keyed_schema, written

DIM = 2048  # a multiple of 64
SEED = 42
UNKNOWN = "und"
BLOCK = 1024  # prototypes broadcast together
PART_BYTES = 1_000_000  # of texts bundled together
PART_ROWS = 512
GRAMS = 2048  # n-gram vectors unpacked together
WEIGHT = 1 << 20  # of one text in its language's bundle


@cache
def _letters() -> np.ndarray:
    """The lower-case letter of every code point, 0 for all that is none."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        if (char := chr(code)).isalpha():
            table[code] = ord(char.lower()[0])
    return table


def letter_vectors(codes: np.ndarray, dim: int = DIM, seed: int = SEED) -> np.ndarray:
    """Random bits of each letter, ``dim / 64`` words of 64; the border's is as random."""
    word = np.arange(dim // 64, dtype=np.uint64)
    with np.errstate(over="ignore"):  # fixed values: the steps of splitmix64
        x = codes.astype(np.uint64)[:, None] * np.uint64(dim // 64) + word
        x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_vectors(grams: np.ndarray, dim: int = DIM, seed: int = SEED) -> np.ndarray:
    """Vectors of n-grams (rows of letters) as -1 and 1.

    A set bit stands for -1, so that a product of signs is an exclusive or of bits.
    """
    codes, at = np.unique(grams, return_inverse=True)
    letters = letter_vectors(codes, dim, seed)
    at = at.reshape(grams.shape)
    bound = np.zeros((len(grams), dim // 64), np.uint64)
    for place in range(grams.shape[1]):
        # Rotated by a bit and a word once per letter behind this one.
        turns = grams.shape[1] - 1 - place
        turned = np.roll(letters, turns, axis=1)
        if turns:
            turned = turned << np.uint64(turns) | turned >> np.uint64(64 - turns)
        bound ^= turned[at[:, place]]
    bits = np.unpackbits(bound.view(np.uint8), axis=1)
    return 1 - 2 * bits.astype(np.float32)


def text_grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts, as rows of letters, and which text each is of.

    One for every letter, with what is on both sides of it.
    """
    plain = [(text or b"").decode("utf-8", "replace") for text in texts]
    points = np.frombuffer("\0".join([*plain, ""]).encode("utf-32-le"), np.uint32)
    letters = _letters()[points]
    number = np.repeat(np.arange(len(texts)), [len(text) + 1 for text in plain])
    letter = np.flatnonzero(letters)
    before = np.append(0, letters)[letter]
    return np.stack([before, letters[letter], letters[letter + 1]], axis=1), number[letter]


def _counted(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams; per n-gram met, its number and the text it is in."""
    rows, number = text_grams(texts)
    at, keys = pd.factorize(rows[:, 0] << 42 | rows[:, 1] << 21 | rows[:, 2])
    distinct = np.empty((len(keys), 3), np.int64)
    distinct[at] = rows
    return distinct, at, number


def bundles(texts: list[bytes | None], dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """The sum of each text's n-gram vectors (whole numbers, exact), and how many it has."""
    distinct, at, number = _counted(texts)
    found = np.zeros((len(texts), dim))
    order = np.argsort(at // GRAMS, kind="stable")
    bounds = np.searchsorted(at[order] // GRAMS, np.arange(-(-len(distinct) // GRAMS) + 1))
    for block, (start, end) in enumerate(zip(bounds, bounds[1:])):
        grams = distinct[block * GRAMS : (block + 1) * GRAMS]
        chosen = order[start:end]
        cell = number[chosen] * len(grams) + at[chosen] - block * GRAMS
        counts = np.bincount(cell, minlength=len(texts) * len(grams)).reshape(len(texts), -1)
        # Sums of fewer than 2**24 signs are exact in single precision.
        kind = np.float32 if end - start < 1 << 24 else np.float64
        found += counts.astype(kind) @ gram_vectors(grams, dim).astype(kind, copy=False)
    return found, np.bincount(number, minlength=len(texts))


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with little text together, or a single longer one."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
        number = np.arange(len(sizes))
        group = (np.cumsum(sizes) - sizes) // PART_BYTES + np.cumsum(sizes > PART_BYTES)
        starts = np.flatnonzero((np.diff(group, prepend=-1) > 0) | (number % PART_ROWS == 0))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def learn(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", dim: int = DIM
) -> DataFrame:
    """``lang, vector``: the prototype of every language that has a text with a letter."""
    docs = columns(labelled, lang=lang_col, text=text_col)
    docs = as_bytes(docs.withColumn("lang", F.col("lang").cast("string")), "text")

    def result(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        vectors = np.concatenate(list(sums.values()))
        offsets = np.arange(0, len(vectors) + 1, dim, dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors))
        return pa.RecordBatch.from_arrays([pa.array(list(sums)), lists], ["lang", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in _parts(batches, 1):
            languages = part.column(0).dictionary_encode()
            distinct, at, number = _counted(part.column(1).to_pylist())
            lengths = np.bincount(number, minlength=part.num_rows)
            cell, counts = np.unique(number * max(1, len(distinct)) + at, return_counts=True)
            of_text, gram = np.divmod(cell, max(1, len(distinct)))
            weights = np.rint(counts * (WEIGHT / lengths[of_text]))
            of_language = languages.indices.to_numpy()[of_text]
            vectors = np.zeros((len(languages.dictionary), dim))
            for start in range(0, len(distinct), GRAMS):
                grams = distinct[start : start + GRAMS]
                chosen = (gram >= start) & (gram < start + GRAMS)
                place = of_language[chosen] * len(grams) + gram[chosen] - start
                shape = (len(vectors), len(grams))
                table = np.bincount(place, weights[chosen], minlength=shape[0] * shape[1])
                vectors += table.reshape(shape) @ gram_vectors(grams, dim)
            for name in np.unique(of_language):
                key = languages.dictionary[int(name)].as_py()
                sums[key] = sums.get(key, 0) + vectors[name].astype(np.int64)
            if len(sums) > BLOCK:
                yield result(sums)
                sums = {}
        if sums:
            yield result(sums)

    return (
        docs.where(F.col("lang").isNotNull())
        .mapInArrow(run, "lang string, vector array<bigint>")
        .select("lang", F.posexplode("vector").alias("at", "weight"))
        .groupBy("lang", "at")
        .agg(F.sum("weight").alias("weight"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("all"))
        .select("lang", F.col("all.weight").alias("vector"))
    )


def predict(
    docs: DataFrame, prototypes: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` (the cosine, 0 where it is negative) of every document."""
    spark = docs.sparkSession
    prototypes = written(prototypes, "prototypes")
    known = sorted(r.lang for r in prototypes.select("lang").collect())
    best = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text").withColumns(
        {"lang_pred": F.lit(UNKNOWN), "cosine": F.lit(None).cast("double")}
    )
    schema = keyed_schema(best, "text binary, lang_pred string, cosine double")
    for start in range(0, len(known), BLOCK):
        names = known[start : start + BLOCK]
        rows = prototypes.where(F.col("lang").between(names[0], names[-1])).toArrow()
        rows = rows.sort_by("lang")
        shape = (rows.num_rows, -1)
        vectors = rows["vector"].combine_chunks().flatten().to_numpy().reshape(shape)
        block = spark.sparkContext.broadcast((rows["lang"].to_pylist(), vectors))
        if start:
            best = written(best, "languages")  # one block is held at a time
        best = best.mapInArrow(_closest(block, len(known) <= start + BLOCK), schema)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("cosine", F.lit(0.0))))
    return best.select("doc_id", "lang_pred", score.alias("score"))


def _closest(block, last: bool):
    """Keep the better of what a row has and the closest language of this block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors = block.value
        unit = vectors / np.maximum(np.linalg.norm(vectors.astype(float), axis=1), 1)[:, None]
        for part in _parts(batches, 1):
            found, grams = bundles(part.column(1).to_pylist(), vectors.shape[1])
            length = np.linalg.norm(found, axis=1)
            # Rounded, so that the order in which a sum is made does not show.
            cosine = np.round(found @ unit.T / np.maximum(length, 1)[:, None], 9)
            choice = cosine.argmax(axis=1)
            before = part.column(3).to_pylist()
            languages, cosines = part.column(2).to_pylist(), before
            for i in np.flatnonzero(grams):
                if before[i] is None or cosine[i, choice[i]] > before[i]:
                    languages[i], cosines[i] = names[choice[i]], float(cosine[i, choice[i]])
            text = pa.nulls(part.num_rows, pa.binary()) if last else part.column(1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), text, pa.array(languages, pa.string()), pa.array(cosines, pa.float64())],
                names=["doc_id", "text", "lang_pred", "cosine"],
            )

    return run
