"""The stages against brute force, each on its own input."""

import re
from collections import Counter

import corpus_pipeline as cp
import pytest
from test_documents import lower, plain_classes, plain_fingerprint, plain_passages, plain_quality
from test_lines_shards_chat import plain_lines
from test_tokens import check_pieces, plain_ids

import __spark_entry__ as contract
from reviewloom.llm import queries as q

SF = "/root/testdata/sf0.001"


def reread(spark, df, path):
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return [tuple(r) for r in df.select(cp.COLUMNS).collect()]


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_stages(spark, awkward, tmp_path, source):
    docs = q.table(spark, SF, "documents") if source == "documents" else awkward
    docs = reread(spark, docs, str(tmp_path / "docs"))
    items = [tuple(r) for r in q.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for number, (name, stage) in enumerate(cp.STAGES[:-1]):
        before = rows_of(docs)
        docs = reread(spark, stage(spark, docs, SF), str(tmp_path / str(number)))
        assert docs.columns == cp.COLUMNS
        after = rows_of(docs)
        if name == "quality rules":
            judged = plain_quality([(i, text, lang) for i, (_, text, lang, _, _) in enumerate(before)])
            kept = {r[0] for r in judged if r[-1]}
            assert Counter(after) == Counter(r for i, r in enumerate(before) if i in kept)
        elif name == "line dedup":
            texts = plain_lines([(i, r[1]) for i, r in enumerate(before)], 10)
            expected = [(before[i][0], t, *before[i][2:4], len(t)) for i, _, _, t in texts]
            assert Counter(after) == Counter(expected)
        elif name == "SimHash near-dedup":
            classes = plain_classes([plain_fingerprint(r[1]) for r in before], 2)
            smallest = {}
            for c, r in zip(classes, before):
                smallest.setdefault(c, []).append(r)
            # NULL ids come first, as in Spark's order.
            best = [min(g, key=lambda r: (r[0] is not None, r[0] or 0))[0] for g in smallest.values()]
            assert Counter(r[0] for r in after) == Counter(best)
            assert not Counter(after) - Counter(before)
        else:
            assert not any(r[2] for r in plain_passages([(i, r[1]) for i, r in enumerate(after)], items))
            hits = {r[0]: r[2] for r in plain_passages([(i, r[1]) for i, r in enumerate(before)], items)}
            clean = Counter(r[:4] for i, r in enumerate(before) if not hits[i])
            assert not clean - Counter(r[:4] for r in after)
            gone = Counter(r[0] for r in before) - Counter(r[0] for r in after)
            cut = [r for i, r in enumerate(before) if r[0] in gone and hits[i]]
            assert len(cut) == sum(gone.values())
        assert all(r[4] == (None if r[1] is None else len(r[1])) for r in after if r[4] is not None)
    check_pieces([(r[0], r[1]) for r in rows_of(docs)], cp.pack(spark, docs, SF).collect())


def test_numbers_hold_when_the_cluster_changes(spark, tmp_path, monkeypatch):
    """The scan is split otherwise for each evaluation, as when executors come or go."""
    path = str(tmp_path / "many")
    docs = q.table(spark, "/root/testdata/sf0.01", "documents").select(cp.COLUMNS)
    docs.repartition(8).write.parquet(path)
    docs = spark.read.parquet(path)
    expected = Counter(rows_of(cp.simhash_dedup(spark, docs, SF)))
    found = cp.simhash.near_duplicates

    def then_more_cores(*args, **options):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        classes = found(*args, **options)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "32")
        return classes

    monkeypatch.setattr(cp.simhash, "near_duplicates", then_more_cores)
    try:
        assert Counter(rows_of(cp.simhash_dedup(spark, docs, SF))) == expected
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_run_is_the_stages_in_order(spark, tmp_path):
    docs = q.table(spark, SF, "documents")
    for number, (_, stage) in enumerate(cp.STAGES):
        docs = reread(spark, stage(spark, docs, SF), str(tmp_path / str(number)))
    key = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.collect())
    found = contract.queries()["pipeline"](spark, SF)
    assert set(key(found)) == set(key(docs))


def test_the_last_stage_returns_the_sequences(spark):
    docs = q.table(spark, SF, "documents").select(cp.COLUMNS)
    whole = {}
    for r in sorted(cp.pack(spark, docs, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == r.length
        whole.setdefault(r.doc_id, []).extend(r.ids)
    assert whole == {r.doc_id: [*plain_ids(r.text), 2] for r in docs.collect()}


def test_nothing_in_nothing_out(spark, nothing, tmp_path):
    docs = reread(spark, nothing.select(cp.COLUMNS), str(tmp_path / "empty"))
    for number, (_, stage) in enumerate(cp.STAGES):
        docs = reread(spark, stage(spark, docs, SF), str(tmp_path / str(number)))
        assert docs.count() == 0


SCHEMAS = {
    "op1_quality_rules": """doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint,
      n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean""",
    "op2_license_scan": """doc_id bigint, n_words bigint, n_base bigint, first_word bigint,
      last_word bigint, base_labels string, labels string, score double""",
    "op3_packing": """doc_id bigint, start bigint, length bigint, ids_crc32 bigint,
      doc_tokens bigint, sequence_id bigint, offset bigint""",
    "op4_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op6_decontamination": """doc_id bigint, n_words bigint, n_hit bigint, n_items bigint,
      items_sha256 string, contaminated boolean""",
    "op7_sharding": """doc_id bigint, size bigint, text_crc32 bigint, law string, shard int,
      slot bigint, grown_shard int""",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_chat_formatting": """conv_id bigint, n_turns bigint, turns_sha256 string,
      loss_chars bigint, loss_sha256 string, formatted_chars bigint""",
    "op11_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op12_structure_repair": """conv_id bigint, gaps bigint, blank bigint, duplicate bigint,
      truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string""",
    "op13_token_alignment": """doc_id bigint, n_a bigint, n_b bigint, n_groups bigint,
      n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string""",
}


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_columns_and_types(spark, name):
    found = dict(q.QUERIES[name](spark, SF).dtypes)
    for column in SCHEMAS[name].split(","):
        column, kind = column.split()
        assert found[column] == kind, column


def test_contract():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", name)) for name in names) == 1
    assert lower("ÀA") == "Àa" and "pipeline" in names
