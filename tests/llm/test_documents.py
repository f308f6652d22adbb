"""Quality, licenses, decontamination and near-duplicates against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.llm import common, decontaminate, fmindex, licenses, quality, simhash
from reviewloom.llm import queries as q
from reviewloom.llm.components import components

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- Quality rules -------------------------------------------------------


def plain_base(text):
    text = text or ""
    words = BLANK.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dups += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dups, len(repeated)


def plain_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * np.log2(a / m) if a else 0) + (b * np.log2(b / m) if b else 0)
    return (total / 2) ** 0.5


def plain_histograms(text, listed):
    sets = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[.,;:'\"?()-]"]
    counts = [len(re.findall(s, text)) for s in sets]
    beyond = len(re.findall(r"[^\x00-\x7F]", text))
    counts += [len(text) - sum(counts) - beyond, beyond]
    words = Counter(ALNUM.findall(lower(text)))
    common = [words[w] for w in listed]
    common += [0] * (20 - len(common))
    return counts, [*common, sum(words.values()) - sum(common)]


def plain_quality(rows):
    """doc -> base counts, failed, kept of rows (id, text, lang)."""
    long = {}
    for _, text, lang in rows:
        if lang and plain_base(text)[0] >= 50:
            long.setdefault(lang, []).append(text)
    references, lists = {}, {}
    for lang, texts in long.items():
        if len(texts) < 20:
            continue
        if lang in quality.COMMON:
            lists[lang] = quality.COMMON[lang].split()
        else:
            held = Counter(w for t in texts for w in set(ALNUM.findall(lower(t))))
            lists[lang] = sorted(held, key=lambda w: (-held[w], w.encode()))[:20]
        shares = [
            [[c * 10**6 // max(1, sum(h)) for c in h] for h in plain_histograms(t, lists[lang])]
            for t in texts
        ]
        references[lang] = [np.sum([d[i] for d in shares], axis=0) for i in (0, 1)]
    found = []
    for key, text, lang in rows:
        base = plain_base(text)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        kept = not failed
        if base[0] >= 50 and lang in references:
            near, apart = (
                plain_distance(h, r) if sum(h) else 0
                for h, r in zip(plain_histograms(text, lists[lang]), references[lang])
            )
            kept = kept and near <= 0.25 and apart <= 0.25 + 1 / base[0] ** 0.5
        found.append((key, *base, failed, kept))
    return Counter(found)


FIELDS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()


def test_quality_against_brute_force(spark, awkward, nothing):
    for docs, judged in (
        (q.table(spark, SF, "documents"), q.op1_quality_rules(spark, SF)),
        (awkward, quality.judge(awkward)),
    ):
        rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
        assert Counter(map(tuple, judged.select(FIELDS).collect())) == plain_quality(rows)
    assert quality.judge(nothing).count() == 0


def test_quality_keeps_the_good_and_drops_the_bad(spark):
    sf = "/root/testdata/sf0.1"
    labels = q.table(spark, sf, "labels").where("quality = 1").select("doc_id")
    judged = q.op1_quality_rules(spark, sf).where("NOT base_failed")
    good = judged.join(labels, "doc_id").agg({"kept": "count"}).first()[0]
    lost = judged.join(labels, "doc_id").where("NOT kept").count()
    assert lost <= 0.001 * good
    junk = q.table(spark, sf, "labels").where("quality = 0").select("doc_id")
    bad = judged.where("n_words >= 100").join(junk, "doc_id")
    assert bad.where("NOT kept").count() > 0.8 * bad.count()


@pytest.mark.parametrize("lang", ["it", "en"])
@pytest.mark.parametrize("size", [19, 20, 21])
def test_a_reference_needs_twenty_documents(spark, lang, size):
    """Listed and unlisted languages alike: below, the base rules alone judge."""
    rand = random.Random(size)
    words = "di che la il un non per una sono con casa tempo giorno uomo vita mano".split()
    rows = [(i, plain_text(rand, words), lang) for i in range(size - 1)]
    rows += [(100, plain_text(rand, ["1234", "56", "78", "90"], 90), lang), (101, "short", lang)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = quality.judge(frame)
    assert Counter(map(tuple, found.select(FIELDS).collect())) == plain_quality(rows)
    junk = found.where("doc_id = 100").first()
    assert junk.kept == (size < 20) and not junk.base_failed


def test_rejections_do_not_depend_on_partitions(awkward):
    runs = [
        Counter(map(str, quality.judge(awkward.repartition(n)).collect())) for n in (1, 4)
    ]
    assert runs[0] == runs[1]


def plain_text(rand, words, size=80):
    return " ".join(rand.choice(words) + rand.choice(["", "", ","]) for _ in range(size))


def test_every_language_has_its_own_reference(spark):
    rand = random.Random(3)
    words = {
        "it": "di che la il un non per una sono con casa tempo giorno uomo vita mano".split(),
        "zh": "\u7684\u4e00 \u662f\u4e0d \u4e86\u4eba \u6211\u5728 \u6709\u4ed6 \u8fd9\u4e3a \u4e4b\u5927 \u6765\u4ee5".split(),
        "ru": "\u0438 \u0432 \u043d\u0435 \u043d\u0430 \u0447\u0442\u043e \u043e\u043d \u0441 \u0434\u043e\u043c".split(),
    }
    rows = [(f"{lang}{i}", plain_text(rand, words[lang]), lang) for lang in words for i in range(40)]
    rows += [(f"few{i}", plain_text(rand, words["ru"]), "uk") for i in range(3)]
    rows += [(f"null{i}", plain_text(rand, words[lang]), None) for i, lang in enumerate(words)]
    rows += [("short", "one two", None), ("junk", "#$ %& " * 3 + plain_text(rand, ["1234", "56", "78", "90"], 90), "it")]
    # Same letters, none of the language's words.
    other = "lorem ipsum dolor amet elit sed tempor labore magna aliqua quis nisi".split()
    rows.append(("foreign", plain_text(rand, other, 400), "it"))
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(4)).collect()}
    clean = {r.doc_id for r in found.values() if not r.base_failed}
    lost = {key for key in clean if not found[key].kept}
    assert lost == {"junk", "foreign"} and "short" not in clean
    assert found["foreign"].character_distance <= quality.MAX_CHARACTER_DISTANCE
    assert found["null0"].character_distance is None and found["few0"].word_distance is None


# --- Licenses ------------------------------------------------------------


def expansions(template):
    """All word sequences of a template as a regular expression over joined words."""
    pattern, position = "", 0
    marks = list(licenses._MARKUP.finditer(template))
    word = lambda text: "".join(f"\n?{re.escape(w)} " for w in ALNUM.findall(lower(text)))
    for m in marks:
        pattern += word(template[position : m.start()])
        position = m.end()
        if m.group(1) == "beginOptional":
            pattern += "(?:"
        elif m.group(1) == "endOptional":
            pattern += ")?"
        else:
            bounds = re.search(r"\.\{(\d+),(\d+)\}", m.group(1))
            if bounds:
                pattern += r"(?:\n?\S+ ){%s,%s}" % bounds.groups()
            else:
                pattern += r"\n?\S+ (?:\S+ )*" if "[^" in m.group(1) else r"(?:\n?\S+ )+"
    return pattern + word(template[position:])


def plain_scan(text):
    words = ALNUM.findall(lower(text))
    # A line feed stands before words that begin a line or a sentence.
    raw, marked, starts, at, end, before = text or "", [], [], 0, 0, ""
    for w, m in zip(words, ALNUM.finditer(lower(raw))):
        gap = raw[end : m.start()]
        capital = "A" <= raw[m.start()] <= "Z" and len(before.encode()) > 3
        border = "\n" in gap or capital and re.search(r"[.!?][^ \t\r\f\v]*[ \t\r\f\v]", gap)
        marked.append("\n" * bool(border) + w + " ")
        starts.append(at)
        at += len(marked[-1])
        end, before = m.end(), w
    joined = "".join(marked)
    places, spans = [], []
    for i, at in enumerate(starts):
        for phrase, label in licenses.PHRASES.items():
            if words[i : i + len(phrase.split())] == phrase.split():
                places.append((i, label))
        for label, template in licenses.TEMPLATES:
            matches = [
                j for j in range(i + 1, len(words) + 1)
                if re.fullmatch(expansions(template), joined[at : starts[j] if j < len(words) else None])
            ] if words[i] + " " in FIRST[template] else []
            if matches:
                spans.append((label, i, max(matches) - i))
    return len(words), sorted(places), sorted(spans)


FIRST = {
    t: {"this ", "licensed ", "released ", "permission ", "under ", "redistribution ", "copyright "}
    for _, t in licenses.TEMPLATES
}

NOTICES = [
    "This work is licensed under the GNU General Public License, version 3.",
    "Copyright (c) 2024 Some One and Others. All rights reserved. cc-by, CC BY 4.0",
    "copyright 1999 2000 holder all rights reserved all rights reserved",
    "Copyright 2024 J. R. Writer Inc. and Others Ltd.\nAll rights reserved",
    "copyright law is a subject\nof many books. All rights reserved",
    "Copyright law is a subject. Books treat it. All rights reserved",
    "copyright 2024 " + "a holder of many words " * 9 + "all rights reserved",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of\nthis "
    "software and associated documentation files (the 'Software'), to deal in the Software "
    "without restriction",
    "licensed under a Creative Commons Attribution 4.0 International License",
    "licensed under cc by-nc 4.0. licensed under cc by 4.0",
    "licensed under the apache license version 2 0 the license",
    "licensed under the apache license version 2",
    "under the terms of the GNU general public license as published by the free software "
    "foundation; either version 3 or later",
]


def test_scan_against_brute_force(spark, awkward, nothing):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)
    texts = [*NOTICES, " ".join(NOTICES), None, "", "cc", "by cc by"]
    texts += [r.text for r in q.table(spark, SF, "documents").collect()][:60]
    for text in texts:
        n, places, spans = scanner.scan(text.encode() if text else None)
        assert (n, sorted(places), sorted(spans)) == plain_scan(text), text
    labels = {s[0] for t in NOTICES for s in plain_scan(t)[2]}
    assert labels >= {"gpl-3.0", "copyright", "mit", "cc-by-4.0", "cc-by-nc-4.0", "apache-2.0"}
    assert licenses.scan_licenses(awkward).count() == awkward.count()
    assert licenses.scan_licenses(nothing).count() == 0


def test_license_query(spark):
    docs = {r.doc_id: r.text for r in q.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    for r in q.op2_license_scan(spark, "/root/testdata/sf0.01").collect():
        words = ALNUM.findall(lower(docs[r.doc_id]))
        at = [(i, label) for i in range(len(words)) for p, label in phrases.items()
              if tuple(words[i : i + len(p)]) == p]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert r.first_word == min((i for i, _ in at), default=None)
        assert r.last_word == max((i for i, _ in at), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not at
        assert 0 <= r.score <= 1


@given(st.text(st.sampled_from("abc "), max_size=40))
def test_automaton_accepts_what_the_pattern_does(text):
    template = ("a<<beginOptional>> b<<beginOptional>> c<<endOptional>><<endOptional>>"
                '<<var;name="v";original="x";match=".{1,2}">> a')
    matcher = licenses.Matcher(licenses.compile_template("t", template))
    words = text.split()
    ends = [j for j in range(1, len(words) + 1)
            if re.fullmatch(r"a (?:b (?:c )?)?(?:\S+ ){1,2}a ", "".join(w + " " for w in words[:j]))]
    assert matcher.longest([w.encode() for w in words], 0) == max(ends, default=0)


@given(st.text(st.sampled_from("abc "), max_size=40), st.sampled_from("+*"))
def test_unbounded_regions_and_all_starts_at_once(text, kind):
    template = f'a b<<var;name="v";original="x";match=".{kind}">> a c'
    matcher = licenses.Matcher(licenses.compile_template("t", template))
    words = text.split()
    expected = []
    starts = [i for i, w in enumerate(words) if w == "a"]
    for i in starts:
        ends = [j for j in range(i + 1, len(words) + 1)
                if re.fullmatch(rf"a b (?:\S+ ){kind}a c ", "".join(w + " " for w in words[i:j]))]
        expected += [(i, max(ends) - i)] if ends else []
    assert matcher.spans([w.encode() for w in words], starts) == expected


def filled(template, holder="the copyright holder"):
    """A template as one text: optional wording in, regions as in the original."""
    template = template.replace('original="the copyright holder"', f'original="{holder}"')
    text = re.sub(r'<<var;name="[^"]*";original="([^"]*)"[^>]*>>', r"\1", template)
    return re.sub("<<(begin|end)Optional>>", " ", text)


BOTH_BSD = ["binary form must reproduce", "PROFITS; OR BUSINESS", "OF THE USE OF THIS SOFTWARE"]
CLAUSES = {
    "mit": ["copies or substantial", "WITHOUT WARRANTY", "TORT OR OTHERWISE"], "bsd": BOTH_BSD,
    "apa": ["irrevocable copyright license", "Redistribution.", "indemnify"],
    "gpl": ["warranty", "patent", "modified"],
}


def test_whole_licenses_need_every_clause(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES + licenses.WHOLE, licenses.PHRASES)
    names = lambda text: {s[0] for s in scanner.find(text.encode())[2] if not s[3]}
    for label, template in licenses.WHOLE:
        text = "Some heading. " + filled(template, "nine words " * 9)
        assert label in names(text)
        assert not {"bsd-2-clause", "bsd-3-clause", "bsd-4-clause"} - {label} & names(text)
        text = " ".join(text.split())
        for clause in CLAUSES[label[:3]]:
            assert clause in text and label not in names(text.replace(clause, "unlike that"))
    bsd = filled(dict(licenses.WHOLE)["bsd-3-clause"])
    rows = [(0, bsd), (1, bsd[:300] + " and more"), (2, "cc by"), (3, "none"),
            (4, filled(dict(licenses.WHOLE)["mit"]).split("including without")[0])]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: [(s.label, s.opening) for s in r.spans] for r in found.collect()}
    assert spans == {0: [("bsd", True), ("bsd-3-clause", False)], 1: [("bsd", True)], 2: [], 3: [], 4: [("mit", True)]}


def test_a_copyright_line_ends_with_its_line_or_sentence():
    scanner = licenses.Scanner(licenses.TEMPLATES + licenses.WHOLE, licenses.PHRASES)
    for end in (" and so on.\nAnd on.", " It ends. There."):
        prose = "copyright law is a subject." + " A few words." * 1700 + end
        assert scanner.scan(f"{prose} All rights reserved".encode())[2] == []
    line = "Copyright (c) 2024 The Long Name of Some Very Large Holder and Its Friends, Inc. All rights reserved."
    assert [s[0] for s in scanner.scan(line.encode())[2]] == ["copyright"]


def test_many_starts_of_an_open_region_take_linear_time():
    scanner = licenses.Scanner(licenses.TEMPLATES + licenses.WHOLE, licenses.PHRASES)
    assert len(scanner.scan(b"copyright " * 100_000 + b"all rights reserved")[2]) > 90_000


def test_openings_score_lower_than_whole_texts(spark, tmp_path):
    mit = filled(dict(licenses.WHOLE)["mit"])
    rows = [(0, mit), (1, mit[:400]), (2, "All rights reserved"), (3, "no"),
            (4, "Copyright 2024 Holder. All rights reserved")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scores = {r.doc_id: r.score for r in q.op2_license_scan(spark, str(tmp_path)).collect()}
    assert scores == {0: 1.0, 1: 0.75, 2: 0.5, 3: 0.0, 4: 0.5}


@pytest.mark.parametrize("bad", [
    "a <<beginOptional>> b", '<<var;name="x";match=".+">> b', "<<beginOptional>>a<<endOptional>>",
    'a <<var;name="x";match="[0-9]+">>',
])
def test_bad_templates_are_refused(bad):
    with pytest.raises(ValueError):
        licenses.Matcher(licenses.compile_template("bad", bad))


# --- Decontamination -----------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=120), st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=6), min_size=1, max_size=8))
def test_index_finds_every_place(sequence, patterns):
    index = fmindex.FMIndex(np.array(sequence, np.int64))
    filled = np.zeros((len(patterns), 6), np.int64)
    for i, p in enumerate(patterns):
        filled[i, 6 - len(p) :] = p
    low, high = index.search(filled, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high):
        found = sorted(index.locate(np.arange(a, max(a, b))).tolist())
        assert found == [i for i in range(len(sequence)) if sequence[i : i + len(p)] == p]


def plain_passages(docs, items):
    phrases = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            phrases.setdefault(tuple(words[i : i + 10]), set()).add("" if item is None else str(item))
    sizes = {len(p) for p in phrases}
    found = []
    for key, text in docs:
        words = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                owners = phrases.get(tuple(words[i : i + size]))
                if owners:
                    hit.update(range(i, i + size))
                    names |= owners
        found.append((key, len(words), len(hit), tuple(sorted(names))))
    return Counter(found)


@pytest.fixture(scope="module")
def leaks(spark, awkward):
    rand = random.Random(5)
    items = [(i, " ".join(rand.choice("abcdefgh") for _ in range(rand.randint(1, 25) + 8)))
             for i in range(12)]
    items += [(None, "short item here"), (3, "A second, with the same id ok"), (90, None), (91, " ")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(1000 + i, f"Before {items[i % 14][1]} after! " * (1 + i % 3), *[None] * 10) for i in range(60)]
    return awkward.union(spark.createDataFrame(docs, awkward.schema)).repartition(4), benchmark


@pytest.mark.parametrize("block_phrases", [10**6, 20])
def test_passages_against_brute_force(leaks, nothing, block_phrases):
    docs, benchmark = leaks
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = plain_passages(rows, [tuple(r) for r in benchmark.collect()])
    found = decontaminate.find_passages(docs, benchmark, block_phrases=block_phrases).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == expected
    assert decontaminate.find_passages(nothing, benchmark).count() == 0
    clean = decontaminate.find_passages(docs, benchmark.where("false")).collect()
    assert not any(r.n_hit for r in clean) and len(clean) == len(rows)


@pytest.mark.parametrize("block_phrases", [10**6, 20])
def test_removal_leaves_no_passage_and_no_clean_text_changed(leaks, block_phrases):
    docs, benchmark = leaks
    items = [tuple(r) for r in benchmark.collect()]
    found = decontaminate.remove_passages(docs, benchmark, block_phrases=block_phrases).collect()
    after = [(r.doc_id, r.text) for r in found]
    assert not any(hit for _, _, hit, _ in plain_passages(after, items))
    before = [(r.doc_id, r.text) for r in docs.collect()]
    clean = Counter(r for r in before if not list(plain_passages([r], items))[0][2])
    assert Counter((r.doc_id, r.text) for r in found if not r.n_removed) == clean


def test_a_cut_that_joins_a_passage_is_cut_again():
    known = decontaminate.phrases([("x", b"a b c d e f g h i j")])
    texts, removed = decontaminate.remove_from([b"z a b c d e (a b c d e f g h i j) f g h i j. y"], known)
    assert texts == [b"z () y"] or b"a" not in texts[0]
    assert removed == [20]


# --- SimHash -------------------------------------------------------------


def plain_fingerprint(text, shingle=3):
    words = BLANK.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, reach):
    """Row number -> class, by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def check_classes(docs, found, shingle=3, reach=2):
    docs = sorted(docs, key=str)
    prints = [plain_fingerprint(text, shingle) for _, text in docs]
    classes = plain_classes(prints, reach)
    smallest = {}
    for (key, _), c in zip(docs, classes):
        if key is not None:
            smallest[c] = min(key, smallest.get(c, key))
    several = Counter(classes)
    expected = Counter(
        (key, p, smallest.get(c) if several[c] > 1 else key)
        for (key, _), p, c in zip(docs, prints, classes)
    )
    assert Counter((r.doc_id, r.point % (1 << 64), r.component_id) for r in found) == expected


def test_simhash_query(spark):
    docs = [tuple(r) for r in q.table(spark, SF, "documents").select("doc_id", "text").collect()]
    rows = q.op9_simhash(spark, SF)
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows.collect())
    found = rows.selectExpr("doc_id", "CAST(conv(fingerprint, 16, -10) AS bigint) AS point", "component_id")
    check_classes(docs, found.collect())


def test_simhash_of_awkward_rows(awkward, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    check_classes(docs, simhash.near_duplicates(awkward).collect())
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("hot", [1, 2, 50, 10**6])
def test_simhash_of_hot_points(spark, monkeypatch, hot):
    """Points met by broadcast (few, some, all of them) and by shuffle give the same classes."""
    monkeypatch.setattr(common, "HOT", hot)
    texts = ["hot text of many copies"] * 40 + ["warm text"] * 12 + ["single %d of its kind" % i for i in range(30)]
    docs = [(i if i % 9 else None, text) for i, text in enumerate([*texts, None, None, ""])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    check_classes(docs, simhash.near_duplicates(df).collect())


def test_counted_joins(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 4)
    keys = [1] * 50 + [2] * 30 + [3] * 5 + [4] * 2 + [None] * 3
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key int, n int")
    known = spark.createDataFrame([(1, 50, "a"), (2, 30, "b"), (3, 5, "c")], "key int, docs int, what string")
    name = {1: "a", 2: "b", 3: "c"}
    for how in ("inner", "left"):
        found = common.join_counted(rows, known, "key", "docs", how)
        assert Counter(map(tuple, found.collect())) == Counter(
            (k, i, name.get(k)) for i, k in enumerate(keys) if how == "left" or k in name
        )


@pytest.mark.parametrize("reach", [0, 2, 5])
def test_close_points_meet_across_shards(spark, reach):
    rand = np.random.default_rng(11)
    centres = rand.integers(0, 1 << 63, 60, dtype=np.uint64)
    points = []
    for c in centres:  # chains and balls of close points, besides random ones
        p = c
        for _ in range(rand.integers(1, 30)):
            for b in rand.integers(0, 64, rand.integers(0, 4)):
                p ^= np.uint64(1) << np.uint64(b)
            points.append(p)
    points += list(rand.integers(0, 1 << 63, 1500, dtype=np.uint64))
    points = sorted({int(p) for p in points})
    df = spark.createDataFrame(
        [(int(np.uint64(p).astype(np.int64)),) for p in points], "point bigint"
    ).repartition(5)
    links = simhash.near_links(df, reach, shard_points=100)
    roots = {r.node: r.root for r in components(links).collect()}
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    classes = plain_classes(points, reach)
    found, expected = {}, {}
    for s, c in zip(signed, classes):
        found.setdefault(roots.get(s, s), set()).add(s)
        expected.setdefault(c, set()).add(s)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    # A forest: links never outnumber points.
    assert links.count() < 3 * len(points)


def test_the_sample_of_the_top_tree_is_small(spark, monkeypatch):
    sizes = []
    build = simhash.build
    monkeypatch.setattr(simhash, "build", lambda points, most: (sizes.append(len(points)), build(points, most))[1])
    points = spark.range(4000).select(F.xxhash64("id").alias("point"))
    simhash.near_links(points)
    monkeypatch.setattr(simhash, "SAMPLE_POINTS", 50)
    simhash.near_links(points)
    assert 0 < sizes[0] < 4000 / 8 and sizes[1] < 100


def test_components_of_chains_and_stars(spark):
    rand = random.Random(2)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)]
    pairs += [(rand.randint(2000, 2200), rand.randint(2000, 2200)) for _ in range(120)] + [(7, 7)]
    rand.shuffle(pairs)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert {r.node: r.root for r in components(df).collect()} == {x: root(x) for x in parent}
    assert components(df.where("false")).count() == 0


def test_phrases_are_made_by_tasks_and_sent_block_by_block(spark, leaks, monkeypatch):
    docs, benchmark = leaks
    own = decontaminate._benchmark(benchmark, "item_id", "text")
    rows = [(r.item_id, r.text and r.text.encode()) for r in own.collect()]
    known = decontaminate.phrases(rows)
    expected = {}
    for row, items in zip(known.patterns.tolist(), known.items):
        words = {n: w for w, n in known.vocabulary.items()}
        expected[b" ".join(words[n] for n in row if n)] = items
    found = decontaminate.distinct_phrases(own).collect()
    assert {bytes(r.phrase): list(r["items"]) for r in found} == expected and len(found) == len(expected)
    sizes = []
    real = decontaminate.numbered_phrases
    monkeypatch.setattr(
        decontaminate, "numbered_phrases", lambda f, *rest: sizes.append(len(f)) or real(f, *rest)
    )
    decontaminate.find_passages(docs, benchmark, block_phrases=30).count()
    assert len(sizes) > 3 and sum(sizes) == len(expected) and max(sizes) < 60
