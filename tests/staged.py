"""The yardstick for the cleaners: every stage in order, none merged or left out."""

from pyspark.sql import Column

from reviewloom.functions import text as t


def clean_review_staged(c: Column) -> Column:
    stages = [
        t.F.trim,
        t.ascii_fold,
        t.strip_html,
        t.strip_urls,
        t.strip_punct_runs,
        t.strip_hyphens,
        t.strip_digits,
        lambda c: t.split_camel(c, ". "),
        t.strip_non_alpha,
        t.strip_single_letters,
        t.collapse_whitespace,
        t.strip_char_runs,
        lambda c: t.split_camel(c, ". "),
        t.collapse_whitespace,
        t.space_dots,
        t.lower_trim,
    ]
    for stage in stages:
        c = stage(c)
    return c
