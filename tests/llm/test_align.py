"""Token groups against plain cuts of the texts, with the libraries' own ids."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewloom.llm import align as A
from reviewloom.llm import queries as q

SF = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(name) for name in (A.A_RANKS, A.B_MODEL)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    # The byte-level alphabet: printable bytes stand for themselves, others follow from 256.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(x): x for x in plain}
    for x in sorted(set(range(256)) - set(plain)):
        shown[chr(256 + len(shown) - len(plain))] = x
    pieces = {i: bytes(shown[c] for c in t) for t, i in a.get_vocab().items() if i < 50256}

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        """A's and B's (id, bytes), or None."""
        if not text:
            return None
        raw = (" " + text).encode()
        found = (
            [(i, pieces[i]) for i in a.encode(" " + text, add_special_tokens=False).ids],
            [(i, piece(i)) for i in b.encode(text)],
        )
        return found if all(b"".join(x for _, x in side) == raw for side in found) else None

    return tokens


def plain_groups(found):
    sides = []
    for side in found:
        at, ends = 0, {}
        for n, (_, piece) in enumerate(side):
            at += len(piece)
            ends[at] = n + 1
        sides.append(ends)
    groups, a, b = [], 0, 0
    for end in sorted(set(sides[0]) & set(sides[1])):
        ids = ([i for i, _ in found[0][a : sides[0][end]]], [i for i, _ in found[1][b : sides[1][end]]])
        groups.append(ids)
        a, b = sides[0][end], sides[1][end]
    return groups


def plain_rows(docs, tokens):
    cut = [(doc_id, text, tokens(text)) for doc_id, text in docs]
    made = [found and plain_groups(found) for _, _, found in cut]
    counts = Counter((a[-1], b[-1]) for groups in made if groups for a, b in groups)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for (doc_id, _, found), groups in zip(cut, made):
        if not groups:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        links = [(a[-1], b[-1]) for a, b in groups]
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            doc_id, len(found[0]), len(found[1]), len(groups), len(links),
            sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(spelled.encode()).hexdigest(),
        )


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_query(spark, awkward, tmp_path, libraries, source, monkeypatch):
    monkeypatch.setattr(A, "TOKENS", 5000)
    docs = q.table(spark, SF, "documents") if source == "documents" else awkward
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter(plain_rows([(r.doc_id, r.text) for r in docs.collect()], libraries))
    found = q.op13_token_alignment(spark, str(tmp_path))
    assert found.columns[1:] == "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert Counter(tuple(r) for r in found.collect()) == expected


SAMPLES = ["", " ", "  ", "a", " a  b ", "x\n\ny", "<|endoftext|> </s> <s>", "▁ piece", "\x00", "ﬁ İ é",
           "日本語の文", "👩‍👩‍👧 ok", "a" * 500, "don't stop!!", "１２３", "　wide", "tab\t\ttab"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(SAMPLES)), max_size=6))
def test_groups_of_any_texts(libraries, texts):
    sides = A._sides(*PATHS)
    for text, found in zip(texts, A.align_texts([t.encode() for t in texts], *sides)):
        expected = libraries(text)
        if expected is None:
            assert found is None
            continue
        a_ids, a_last, b_ids, b_last = found
        assert a_ids.tolist() == [i for i, _ in expected[0]]
        assert b_ids.tolist() == [i for i, _ in expected[1]]
        ends = [np.flatnonzero(x) + 1 for x in (a_last, b_last)]
        groups = [
            (x.tolist(), y.tolist())
            for x, y in zip(np.split(a_ids, ends[0][:-1]), np.split(b_ids, ends[1][:-1]))
        ]
        assert groups == plain_groups(expected)


@given(st.lists(st.integers(1, 60), min_size=1, unique=True), st.lists(st.integers(1, 60), unique=True))
def test_pointer_jumping_cuts_where_both_end(a, b):
    last = max([*a, *b])
    a, b = (np.array(sorted({*x, last})) for x in (a, b))
    a_last, b_last = A.group_ends(a, b)
    common = np.intersect1d(a, b)
    assert np.array_equal(a[a_last], common) and np.array_equal(b[b_last], common)


def test_bad_bytes_have_no_tokens():
    found = A.align_texts([b"fine", b"bad \xff\xfe", None, b""], *A._sides(*PATHS))
    assert [x is not None for x in found] == [True, False, False, False]


def test_group_rows_give_the_texts_back(spark):
    docs = q.table(spark, SF, "documents").limit(40)
    aligned, links = A.aligned_with_counts(docs, *PATHS)
    a, b = (side.pieces.to_pylist() for side in A._sides(*PATHS))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = A.groups(aligned, links, *PATHS).collect()
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.group)):
        assert b"".join(a[i] for i in r.a_ids) == b"".join(b[i] for i in r.b_ids)
        whole[r.doc_id].append(b"".join(a[i] for i in r.a_ids))
    assert {k: b"".join(v).decode() for k, v in whole.items()} == {
        k: " " + t for k, t in texts.items() if t
    }
    counts = Counter((r.a_ids[-1], r.b_ids[-1]) for r in rows)
    assert all(counts[r.a_ids[-1], r.b_ids[-1]] == r.links for r in rows)
    assert len(counts) == len(links.pair) <= A.pair_bound(*PATHS)


def test_nothing(spark, nothing, tmp_path):
    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    assert q.op13_token_alignment(spark, str(tmp_path)).count() == 0
