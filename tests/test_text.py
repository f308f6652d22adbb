import random
import re
import sys
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from staged import clean_review_staged

from reviewloom.functions import text

GOLDEN = [
    (None, None),
    ("", ""),
    ("Works!! See https://shop.example/a?b=1 TODAY...", "works see today"),
    ("<div>Sturdy <i>little</i> stand</div>", "sturdy little stand"),
    ("good<br>bad", "good bad"),
    ("3 < 5 and 7 > 2", ""),
    ("<a\nb>text", "text"),
    ("<ab\rcd>text", "text"),
    ("visit www.site.com, now", "visit now"),
    ("xhttpfoo", ""),
    ("HTTP://X.com", "http com"),
    ("helloWorld", "hello world"),
    ("iPhone", "phone"),
    ("Brand™", "brand tm"),
    ("café", "cafe"),
    ("foo—bar", "foobar"),
    ("don't", "don"),
    ("don’t", "dont"),
    ("good\U0001f44dbad", "goodbad"),
    ("â‚¹399 deal", "deal"),
    ("foo_bar", "foo bar"),
    ("12345", ""),
    ("line1 line2", "line line"),
    (" pad mid ", "pad mid"),
    ("N/A", ""),
    ("None", "none"),
    ("axxxb", "a b"),
    ("XXX", "xxx"),
    ("½ cup ﬁne … www…x", "cup fine"),
    ("word\x1cword http\x1fend", "word word http end"),
]

CLEANERS = [text.clean_review, text.clean_review_native, clean_review_staged]


def run(spark, column_function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    out = rows.select("i", column_function(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(out, key=lambda r: r.i)]


@pytest.mark.parametrize("cleaner", CLEANERS)
def test_golden_pairs(spark, cleaner):
    assert run(spark, cleaner, [g[0] for g in GOLDEN]) == [g[1] for g in GOLDEN]


def random_texts(n, seed):
    pieces = [
        *"aAbBxXhtpw019 .,;:?/\\-_=~<>\n\r\t'\"",
        "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\u3000",
        "http", "http://", "www.", "xxx", "xx", "<b>", "</p>", "helloWorld", "iPhone",
        "é", "ß", "™", "½", "…", "ﬁ", "≮", "＜", "＞", "ｈttp", "ж", "中", "👍", "e\u0301",
    ]
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(n)]


def test_all_three_cleaners_agree_on_random_text(spark):
    texts = random_texts(6000, seed=7)
    fast, native, staged = (run(spark, c, texts) for c in CLEANERS)
    for t, a, b, c in zip(texts, fast, native, staged):
        assert a == b == c, repr(t)


def test_output_alphabet(spark):
    shape = re.compile(r"(?:[a-z]+(?: [a-z]+)*)?")
    for out in run(spark, text.clean_review, random_texts(2000, seed=11)):
        assert shape.fullmatch(out)


def test_fold_every_code_point():
    chars = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    folded = text._fold_udf.func(pa.array(chars)).to_pylist()
    wrong = [
        c
        for c, f in zip(chars, folded)
        if unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() != f
        and unicodedata.name(c, None)  # Unicode versions may differ in new characters
    ]
    assert wrong == []


def test_whole_long_texts(spark):
    long = "word1 <i>x</i> " * 40_000 + "theEnd"
    expected = " ".join(["word"] * 40_000 + ["the", "end"])
    assert run(spark, text.clean_review, [long, "<" * 200_000]) == [expected, ""]


@pytest.mark.parametrize(
    "stage, given, expected",
    [
        (text.strip_html, "a<b c>d<e\nf>g<h", "a d<e\nf>g<h"),
        (text.strip_urls, "see http://x.y/z?q, www.q and http", "see     and http"),
        (text.strip_punct_runs, "a--b==_c...d;:e-f.g", "a b c d e-f.g"),
        (text.strip_hyphens, "a - b--c -", "a b c "),
        (text.strip_digits, "12 a1 3b 4_5 6-7", "  a1 3b 4_5  - "),
        (text.split_camel, "aBcD eF", "a Bc D e F"),
        (text.strip_non_alpha, "a1\tb!\nc", "a \tb \nc"),
        (text.strip_single_letters, "a bc d_e f1 g", "  bc d_e f1  "),
        (text.strip_char_runs, "axxxb xx ---- ::: XXX ~~~", "a b xx     XXX  "),
        (text.collapse_whitespace, " a\n\n b\x1cc\t", "a b c"),
        (text.space_dots, "a.b . c", "a. b. c"),
        (text.lower_trim, "  ÀB c ", "àb c"),
        (text.ascii_fold, "Ünï—™\u2028x", "UniTMx"),
        (text.repair_mojibake, "â‚¹399, â‚¹1", "₹399, ₹1"),
    ],
)
def test_single_stages(spark, stage, given, expected):
    assert run(spark, stage, [given, None]) == [expected, None]


def test_registered_in_sql(spark):
    text.register_functions(spark)
    row = spark.sql("SELECT clean_review('iPhone IS café') AS a, ascii_fold('é') AS b").first()
    assert (row.a, row.b) == ("phone is cafe", "e")


def test_cleaner_runs_once_when_its_result_is_filtered(spark, plan):
    df = spark.range(10).select(text.clean_review_once(F.col("id").cast("string")).alias("t"))
    assert plan(df.where("length(t) > 0")).count("ArrowEvalPython") == 1


def test_a_batch_is_cleaned_some_rows_at_a_time():
    """Texts leave before the next are cleaned, so a batch is not held once more per rule."""
    clean = text._clean_udf.func
    texts = [f"Héllo <b>iPhone</b> {i} " * (1 + i % 90 * 90) for i in range(150)]
    texts += [None, "", "x" * (3 * text.STEP_BYTES), None, "end of it"]
    batch = pa.array(texts)
    pieces = list(clean(iter([batch, batch.slice(0, 0), batch.slice(150, 2), batch.slice(30, 9)])))
    assert len(pieces) > 10
    most = max(len(t or "") for t in texts)
    assert all(piece.nbytes <= max(most, text.STEP_BYTES) + 10_000 for piece in pieces)
    found = [t for piece in pieces for t in piece.to_pylist()]
    alone = [next(clean(iter([pa.array([t], pa.string())])))[0].as_py() for t in texts]
    assert found == alone + alone[150:152] + alone[30:39]
