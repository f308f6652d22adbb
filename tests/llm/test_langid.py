"""Language profiles against a plain version, and against held-out labels."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import langid as L
from reviewloom.llm import queries as q

SF = "/root/testdata/sf0.01"


def plain_bundle(text, dim):
    letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in text or ""]
    total, count = np.zeros(dim), 0
    for i, letter in enumerate(letters):
        if letter:
            gram = [letters[i - 1] if i else 0, letter, letters[i + 1] if i + 1 < len(letters) else 0]
            total += L.gram_vectors(np.array([gram]), dim)[0]
            count += 1
    return total, count


TEXTS = ["", None, "a", "Ab c", "1 2", "\x00x\x00", "Über die Brücke ging er", "the cat " * 40,
         "漢字かな交じり文", "İstanbul ﬁ ʰ", "퟿\U0001f600 z", "word\nword\tword"]


@pytest.mark.parametrize("dim", [64, 256])
def test_bundles_are_sums_of_bound_letters(dim, monkeypatch):
    monkeypatch.setattr(L, "GRAMS", 7)  # several blocks
    found, counts = L.bundles([t and t.encode() for t in TEXTS], dim)
    for text, vector, count in zip(TEXTS, found, counts):
        expected, number = plain_bundle(text, dim)
        assert count == number and np.array_equal(vector, expected), text


def test_binding_is_a_product_of_permuted_letters():
    dim = 128
    a, b, c = (L.letter_vectors(np.array([ord(x)]), dim)[0] for x in "abc")
    signs = lambda words: 1 - 2 * np.unpackbits(words.view(np.uint8)).astype(int)
    gram = L.gram_vectors(np.array([[97, 98, 99]]), dim)[0]

    def turned(words, times):
        rolled = np.roll(words, times)
        return rolled << np.uint64(times) | rolled >> np.uint64(64 - times)

    assert np.array_equal(gram, signs(turned(a, 2)) * signs(turned(b, 1)) * signs(c))
    # Order counts: a rotation is undone by none of the others.
    other = L.gram_vectors(np.array([[99, 98, 97]]), 2048)[0]
    same = L.gram_vectors(np.array([[97, 98, 99]]), 2048)[0]
    assert abs(np.dot(other, same)) / 2048 < 0.1


def plain_prototypes(rows, dim):
    sums = {}
    for text, lang in rows:
        total, count = {}, 0
        letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in text or ""]
        for i, letter in enumerate(letters):
            if letter:
                gram = (letters[i - 1] if i else 0, letter, letters[i + 1] if i + 1 < len(letters) else 0)
                total[gram] = total.get(gram, 0) + 1
                count += 1
        for gram, n in total.items():
            weight = np.rint(n * (L.WEIGHT / count))
            sums[lang] = sums.get(lang, 0) + weight * L.gram_vectors(np.array([gram]), dim)[0]
    return sums


@pytest.mark.parametrize("block", [1, 1024])
def test_learn_and_predict_against_a_plain_version(spark, block, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", block)
    random.seed(3)
    words = {"x": "abcde", "y": "cdefg", "z": "ghijk", None: "xyz"}
    rows = [
        (i, " ".join("".join(random.choices(words[lang], k=5)) for _ in range(6)), lang)
        for i, lang in enumerate(random.choices(list(words), k=60))
    ] + [(100, None, "x"), (101, "12", "q"), (None, "abc cde", "x"), (0, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    prototypes = L.learn(docs, dim=128)
    known = {r.lang: np.array(r.vector, float) for r in prototypes.collect()}
    expected = plain_prototypes([(t, lang) for _, t, lang in rows if lang], 128)
    assert set(known) == set(expected)
    assert all(np.array_equal(known[x], expected[x]) for x in known)
    found = L.predict(docs, prototypes).collect()
    assert len(found) == len(rows)
    names = sorted(known)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for doc_id, text, _ in rows:
        vector, count = plain_bundle(text, 128)
        if not count:
            assert ("und", 0.0) in by_id[doc_id]
            continue
        cosines = [
            round(vector @ known[x] / np.linalg.norm(known[x]) / np.linalg.norm(vector), 9) for x in names
        ]
        best = max(cosines)
        assert any(
            names[cosines.index(best)] == lang and abs(max(0, best) - score) < 1e-8
            for lang, score in by_id[doc_id]
        )


def test_held_out_accuracy(spark):
    docs = q.table(spark, SF, "documents")
    found = q.op11_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.99


def test_labels_of_held_out_rows_teach_nothing(spark, tmp_path):
    docs = q.table(spark, SF, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs.withColumn("lang", F.when(held, "wrong").otherwise(F.col("lang"))).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    before = {r.doc_id: r.lang_pred for r in q.op11_language_id(spark, SF).collect()}
    after = {r.doc_id: r.lang_pred for r in q.op11_language_id(spark, str(tmp_path)).collect()}
    assert before == after


def test_awkward_rows(spark, awkward, nothing):
    prototypes = L.learn(awkward, dim=256)
    found = L.predict(awkward, prototypes).collect()
    assert len(found) == awkward.count()
    assert {r.lang_pred for r in found if r.doc_id in (3, 4, 5)} == {"und"}
    assert L.learn(nothing).count() == 0 and L.predict(nothing, prototypes).count() == 0
    nobody = L.predict(awkward, L.learn(nothing)).collect()
    assert {(r.lang_pred, r.score) for r in nobody} == {("und", 0.0)}
