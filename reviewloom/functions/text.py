"""Text cleaning.

Two ways to get the same cleaned text:

``clean_review``
    One Arrow UDF: the Unicode fold plus a few linear-time RE2 passes over pieces of
    Arrow batches. Spark has no Unicode-normalise function, so the fold has to
    leave the JVM anyway; doing the rest on the same trip takes about a third of
    the time of handing the folded text back to the JVM, and RE2 cannot go
    quadratic on text such as a long run of ``<``.
``clean_review_native``
    The fold, then the same reduced chain as JVM column expressions.

Each stage is also a public ``Column -> Column`` function. Stages after the
fold are defined on ASCII text; word boundaries are spelled out as ASCII so the
result does not depend on the JDK's idea of ``\\b``.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What each stage looks for. Java and RE2 read them alike unless
# marked. Character classes list single characters where they can: a class that
# mixes ranges with other members runs several times slower in Java.
SPACE_CHARS = r" \t\n\x0B\f\r\x1C\x1D\x1E\x1F"
NON_ASCII = r"[^\x00-\x7F]+"
SPACES = rf"[{SPACE_CHARS}]+"
HTML_TAG = r"<[^>\n]*>"
URL = rf"(?:http|www\.)[^{SPACE_CHARS}]+"
DASH_RUN = r"[-_=]{2,}"
PUNCT_RUN = r"[.,;:?/\\]{2,}"
HYPHENS = rf"[{SPACE_CHARS}]*-+[{SPACE_CHARS}]*"
CAMEL = r"([a-z])([A-Z])"
NON_LETTER = rf"[^{ascii_letters}{SPACE_CHARS}]"
DOTS = rf"[{SPACE_CHARS}]*\.[{SPACE_CHARS}]*"
DIGITS = r"(?<!\w)[0-9]+(?!\w)"  # Java
SINGLE_LETTER = r"(?<!\w)[a-zA-Z](?!\w)"  # Java
CHAR_RUN = r"([x\-_:;=~])\1{2,}"  # Java


def _sub(c: Column, pattern: str, replacement: str = " ") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(replacement))


# --- Arrow kernels -------------------------------------------------------

STEP_BYTES = 1 << 20

def _arrow_text_udf(*rules: tuple[str, str], lower: bool = False):
    """Fold to ASCII, then apply RE2 ``(pattern, replacement)`` rules in order, to
    ``STEP_BYTES`` of a batch at a time or one longer text. With rules these are handed on
    as they are done; the fold alone, which is cheap to hold, returns a batch.

    The body is a closure so that it ships to executors by value.
    """
    non_ascii, step_bytes = NON_ASCII, STEP_BYTES

    def clean(some: pa.Array) -> pa.Array:
        # Copies are common, and finding them costs a few percent of cleaning
        # them: work on the distinct texts.
        distinct = some.dictionary_encode()
        texts = distinct.dictionary
        needs_fold = pc.fill_null(pc.invert(pc.string_is_ascii(texts)), False)
        if pc.any(needs_fold).as_py():
            folded = pc.utf8_normalize(texts.filter(needs_fold), form="NFKD")
            folded = pc.replace_substring_regex(folded, non_ascii, "")
            texts = pc.replace_with_mask(texts, needs_fold, folded)
        for pattern, replacement in rules:
            texts = pc.replace_substring_regex(texts, pattern, replacement)
        if lower:
            texts = pc.ascii_lower(pc.ascii_trim(texts, " "))
        return texts.take(distinct.indices)

    def pieces(batch: pa.Array) -> Iterator[pa.Array]:
        # Every rule makes new texts: of a few rows at a time, which leave before the
        # next are cleaned.
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < len(batch):
            most = ends[start] - sizes[start] + step_bytes
            stop = max(start + 1, int(np.searchsorted(ends, most, side="right")))
            yield clean(batch.slice(start, stop - start))
            start = stop

    def run(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays(list(pieces(batch))) if len(batch) else batch

    def run_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from pieces(batch)
            del batch  # before another comes

    return F.arrow_udf(run_all if rules else run, T.StringType())


_fold_udf = _arrow_text_udf()
_CLEAN_RULES = (
    (HTML_TAG, " "),
    (URL, " "),
    (CAMEL, r"\1 \2"),
    # A gap becomes one space, unless it is one already: most are, and leaving
    # them alone is what keeps the number of matches small.
    (r" ?[^a-zA-Z ][^a-zA-Z]*", " "),
    (r"\b[a-zA-Z]\b ?", ""),
    (r"xxx+", " "),
    (r"  +", " "),
)
_clean_udf = _arrow_text_udf(*_CLEAN_RULES, lower=True)
# The same, marked non-deterministic (it is not): Catalyst would push a filter on
# its result below the projection and clean every row twice.
_clean_once_udf = _arrow_text_udf(*_CLEAN_RULES, lower=True).asNondeterministic()


def ascii_fold(c: Column) -> Column:
    """NFKD-decompose, then drop (not replace) every non-ASCII character."""
    return _fold_udf(c)


def clean_review(c: Column) -> Column:
    """Fully cleaned text: '' or words of [a-z] joined by single spaces."""
    return _clean_udf(c)


def clean_review_once(c: Column) -> Column:
    """``clean_review`` for a column that is filtered on next.

    No filter above it reaches the scan: apply those on other columns before.
    """
    return _clean_once_udf(c)


def register_functions(spark: SparkSession) -> None:
    """Make the cleaner and the fold callable from ``spark.sql``."""
    spark.udf.register("clean_review", _clean_udf)
    spark.udf.register("ascii_fold", _fold_udf)


# --- Single stages -------------------------------------------------------


def strip_html(c: Column) -> Column:
    return _sub(c, HTML_TAG)


def strip_urls(c: Column) -> Column:
    return _sub(c, URL)


def strip_punct_runs(c: Column) -> Column:
    return _sub(_sub(c, DASH_RUN), PUNCT_RUN)


def strip_hyphens(c: Column) -> Column:
    return _sub(c, HYPHENS)


def strip_digits(c: Column) -> Column:
    return _sub(c, DIGITS)


def split_camel(c: Column, joiner: str = " ") -> Column:
    return _sub(c, CAMEL, f"$1{joiner}$2")


def strip_non_alpha(c: Column) -> Column:
    return _sub(c, NON_LETTER)


def strip_single_letters(c: Column) -> Column:
    return _sub(c, SINGLE_LETTER)


def strip_char_runs(c: Column) -> Column:
    return _sub(c, CHAR_RUN)


def collapse_whitespace(c: Column) -> Column:
    return F.trim(_sub(c, SPACES))


def space_dots(c: Column) -> Column:
    return _sub(c, DOTS, ". ")


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def repair_mojibake(c: Column) -> Column:
    """Put back the rupee sign where UTF-8 was read as Windows-1252."""
    return F.replace(c, F.lit("â‚¹"), F.lit("₹"))


# --- Chains --------------------------------------------------------------


def clean_review_native(c: Column) -> Column:
    """``clean_review`` with everything after the fold inside the JVM."""
    c = split_camel(strip_urls(strip_html(ascii_fold(c))))
    as_is = F.lit(None).cast("string")
    c = F.mask(c, as_is, as_is, F.lit(" "), F.lit(" "))  # all but letters blanked out
    c = _sub(strip_single_letters(c), r"x{3,}")
    return lower_trim(_sub(c, r" {2,}"))
