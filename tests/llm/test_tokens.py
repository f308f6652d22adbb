"""Packing, matrices and counts against plain use of the tokenizer library."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewloom.llm import lengths, matrices, packing
from reviewloom.llm import queries as q
from reviewloom.llm.tokens import Encoder, vocabulary_path

PATH = vocabulary_path()
PLAIN = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


ODD = st.one_of(
    st.characters(codec="utf-8"), st.sampled_from("aAbΣİé\u0301\u030cJjÅ '’\n<|>!.,\u00a0\x1c²")
)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.text(ODD), max_size=3))
def test_words_encode_like_whole_texts(texts):
    found = Encoder_shared.encode_ids([t.encode() for t in texts])
    assert found == [plain_ids(t) for t in texts]


Encoder_shared = Encoder(PATH)


@pytest.mark.parametrize("text", [
    "\u09b9\u09df,", "\u09dc! \u09dd.", "\u0130,", "Diyarbak\u0130; x\u0130", "\u0958, \u095f?",
    "\ufb2a.", "\u0a33) \u0b5c]", "\u0f43:", "\u03a3\u0391\u03a3, \u00c9t\u00e9.",
])
def test_letters_that_the_normalizer_splits(text):
    assert Encoder(PATH).encode_ids([text.encode()]) == [plain_ids(text)]


def test_every_letter_before_punctuation():
    words = [c + "," for c in map(chr, range(0x110000)) if c.isalpha()]
    plain = [e.ids for e in PLAIN.encode_batch(words, add_special_tokens=False)]
    assert Encoder(PATH).encode_ids([w.encode() for w in words]) == plain


def test_memory_of_words_is_bounded_and_harmless(monkeypatch):
    import reviewloom.llm.tokens as tokens

    monkeypatch.setattr(tokens, "WORDS_REMEMBERED", 5)
    small = Encoder(PATH)
    texts = ["<|endoftext|>end a,b", *[f"some Words number {i}, again!" for i in range(200)]]
    assert small.encode_ids([t.encode() for t in texts]) == [plain_ids(t) for t in texts]
    assert len(small._new) < 400


def check_pieces(docs, rows):
    """Each id once, gapless sequences of at most 4096, right digests."""
    expected = Counter()
    for key, text in docs:
        expected[key, tuple(plain_ids(text) + [2])] += 1
    pieces = Counter()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    cuts = {}
    for r in rows:
        cuts.setdefault((r.doc_id, r.doc_tokens), set()).add((r.start, r.length))
    for (key, ids), _ in expected.items():
        covered = sorted(cuts[key, len(ids)])
        ends = [s + n for s, n in covered]
        assert covered[0][0] == 0 and len(ids) in ends
        for start, size in covered:
            digest = zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())
            assert pieces[key, start, size, digest, len(ids)] >= 1 or len(
                {i for k, i in expected if k == key and len(i) == len(ids)}
            ) > 1
    assert sum(r.length for r in rows) == sum(len(i) * n for (_, i), n in expected.items())
    for members in by_sequence.values():
        at = 0
        for offset, size in sorted(members):
            assert offset == at
            at += size
        assert at <= 4096
    return by_sequence


def test_packing_query(spark):
    docs = q.table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = q.op3_packing(spark, SF).collect()
    sequences = check_pieces(docs, rows)
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.03 * total / 4096 + 1


def test_digests_come_from_the_ids(spark):
    docs = q.table(spark, SF, "documents")
    pieces = packing.pack_documents(docs, PATH, with_ids=True).withColumn("ids_crc32", F.lit(-1).cast("bigint"))
    found = q.digest_pieces(pieces)
    assert found.columns == packing.pack_documents(docs, PATH).columns
    key = lambda r: (r.doc_id, r.start, r.sequence_id, r.offset)
    expected = {key(r): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces.collect()}
    assert {key(r): r.ids_crc32 for r in found.collect()} == expected


def test_packing_of_awkward_rows(awkward, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    check_pieces(docs, packing.pack_documents(awkward, PATH).collect())
    assert packing.pack_documents(nothing, PATH).count() == 0
    # Small blocks, wanted ids.
    rows = packing.pack_documents(awkward, PATH, block_tokens=100, with_ids=True).collect()
    check_pieces(docs, rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("size", [lambda r: 683, lambda r: 2100, lambda r: r.randint(1, 4095)])
def test_differencing_is_even_and_windows_rise(size):
    rand = random.Random(7)
    sizes = [size(rand) for _ in range(400)]
    windows = packing.pack(sizes, 4096)
    assert sorted(i for w in windows for i in w) == list(range(400))
    assert max(sum(sizes[i] for i in w) for w in windows) <= 4096
    parts = packing.pack_rests(sizes, 4096)
    assert len(parts) <= 1.04 * sum(sizes) / 4096 + 1
    whole = Counter()
    for window in parts:
        for i, _, length in window:
            whole[i] += length
    assert whole == Counter(dict(enumerate(sizes)))


def test_differencing_in_two_is_the_classic():
    # 8 7 6 5 4: differencing gives 16 | 14.
    found = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in found) == [14, 16]


def test_best_fit_takes_the_tightest_row():
    rand = random.Random(3)
    sizes = [rand.randint(1, 100) for _ in range(300)]
    rows, free = [], []
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        fitting = [j for j in range(len(rows)) if free[j] >= sizes[i]]
        if not fitting:
            rows.append([])
            free.append(100)
            fitting = [len(rows) - 1]
        j = min(fitting, key=lambda j: free[j])
        rows[j].append(i)
        free[j] -= sizes[i]
    found = matrices.best_fit(sizes, 100)
    fill = lambda rows: sorted(sum(sizes[i] for i in r) for r in rows)
    assert fill(found) == fill(rows)


def restored(rows, capacity):
    """(doc, start, ids) of every piece, read back from the binary rows."""
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u2")
        positions = np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == capacity
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= capacity
        assert not ids[r.n_tokens :].any()
        for key, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            yield key, start, tuple(ids[a:b].tolist())


def test_matrices_round_trip(spark, awkward, nothing, tmp_path):
    for docs, packed in (
        (q.table(spark, SF, "documents"), q.op5_token_matrices(spark, SF)),
        (awkward, matrices.pack_matrices(awkward, PATH)),
    ):
        path = str(tmp_path / f"packed{docs.count()}")
        matrices.write_matrices(packed, path)
        pieces = Counter(restored(spark.read.parquet(path).collect(), 4096))
        expected = Counter()
        for r in docs.collect():
            ids = plain_ids(r.text) + [2]
            for start in range(0, len(ids), 4096):
                expected[r.doc_id, start, tuple(ids[start : start + 4096])] += 1
        assert pieces == expected
    assert matrices.pack_matrices(nothing, PATH).count() == 0


def test_counts(spark, awkward, nothing):
    for docs, table in (
        (q.table(spark, SF, "documents"), q.op8_token_counts(spark, SF)),
        (awkward, lengths.length_table(lengths.encoded_lengths(awkward, PATH))),
    ):
        sizes = [len(plain_ids(r.text)) for r in docs.collect()]
        rows = {r.length: r for r in table.collect()}
        assert set(rows) == set(sizes)
        for size, r in rows.items():
            assert r.docs == sizes.count(size) and r.tokens == size * r.docs
            assert r.docs_at_least == sum(s >= size for s in sizes)
            assert r.tokens_at_least == sum(s for s in sizes if s >= size)
            assert r.docs_at_most == sum(s <= size for s in sizes)
            assert r.tokens_cut == sum(min(s, size) for s in sizes)
        for limit in (0, 1, 100, 5000, 10**9):
            cut = lengths.cut_total(table, limit).first().tokens_cut
            assert cut == sum(min(s, limit) for s in sizes)
        for share in (0.1, 0.5, 0.99, 1.0):
            at = sorted(sizes)[int(np.ceil(share * len(sizes))) - 1]
            assert lengths.quantile(table, share).first().length == at
    empty = lengths.length_table(lengths.encoded_lengths(nothing, PATH))
    assert empty.count() == 0
    assert lengths.cut_total(empty, 10).first().tokens_cut == 0


def test_quantiles_are_those_of_the_written_share(spark):
    counts = [(i, 1) for i in range(1, 101)]
    table = lengths.length_table(spark.createDataFrame(counts, "length bigint, docs bigint"))
    rows = table.cache().collect()
    everyone = sum(r.docs for r in rows)
    for k in range(1, 101):
        share = k / 100
        wanted = Fraction(str(share)) * everyone
        expected = min(r.length for r in rows if r.docs_at_most >= wanted)
        assert lengths.quantile(table, share).first().length == expected == k, share
    table.unpersist()
