"""The operators over their whole tables, with production parameters.

``QUERIES`` maps names to functions of (spark, sf_dir); ``SQL`` has DuckDB
statements with the same rows where SQL can express them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reviewloom.llm import (
    align,
    chat,
    decontaminate,
    langid,
    lengths,
    licenses,
    lines,
    matrices,
    packing,
    quality,
    repair,
    shards,
    simhash,
)
from reviewloom.llm.common import keyed_schema
from reviewloom.llm.tokens import vocabulary_path
from reviewloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
CHAT_TOKENIZER = "byte_bpe_50k.tiktoken"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.col("places.start")
    base = F.array_distinct("places.label")
    method = F.array_union(F.col("places.label"), F.col("spans.label"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(method), ",").alias("labels"),
        # A whole text or notice is certain; an opening may have other conditions behind
        # it; a phrase alone, or a copyright line, which is no license, is a hint.
        F.when(F.exists("spans", lambda span: ~span.opening & (span.label != "copyright")), 1.0)
        .when(F.exists("spans", lambda span: span.opening), 0.75)
        .when(F.size("places") + F.size("spans") > 0, 0.5)
        .otherwise(0.0)
        .alias("score"),
    )


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest_pieces(packing.pack_documents(docs, vocabulary_path(TOKENIZER), with_ids=True))


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces without their ids; ``ids_crc32`` is that of the ids as 4 bytes each."""
    schema = pieces.drop("ids").schema
    at = schema.names.index("ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, bounds = ids.values.to_numpy().astype("<i4"), ids.offsets.to_pylist()
            digests = [zlib.crc32(values[a:b]) for a, b in zip(bounds, bounds[1:])]
            arrays = [batch.column(name) for name in schema.names]
            arrays[at] = pa.array(digests, pa.int64())
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return pieces.mapInArrow(run, schema)


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", digest)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL["op4_line_dedup"] = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i FROM split),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_STRIP})")} AS line_key FROM lines),
often AS (
  SELECT line_key, true AS repeated FROM keyed WHERE line_key <> ''
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(repeated) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (repeated IS NULL), ''))
    AS kept_sha256
FROM keyed LEFT JOIN often USING (line_key) GROUP BY doc_id"""


@query
def op5_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices as they were written."""
    packed = matrices.pack_matrices(
        table(spark, sf_dir, "documents"), vocabulary_path(TOKENIZER)
    )
    path = scratch_path(spark, "matrices")
    matrices.write_matrices(packed, path)
    return spark.read.schema(packed.schema).parquet(path)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all("
    + _LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL["op6_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
starts AS (
  SELECT item, words, least(len(words), 10) AS size,
    unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS p
  FROM items WHERE len(words) > 0),
phrases AS (
  SELECT DISTINCT item, size, array_to_string(words[p:p + size - 1], ' ') AS phrase FROM starts),
sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
  FROM docs JOIN sizes ON len(words) >= size),
hits AS (
  SELECT doc_id, places.size, p, item FROM places JOIN phrases
  ON phrases.size = places.size
    AND phrases.phrase = array_to_string(words[p:p + places.size - 1], ' ')),
hit_words AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS w FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return dealt.select(
        "record.doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lengths.length_table(lengths.encoded_lengths(docs, vocabulary_path(TOKENIZER)))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    # In the types of the table, whatever its ids are.
    return given.union(own.select(*[F.col(f.name).cast(f.dataType) for f in given.schema]))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = vocabulary_path(CHAT_TOKENIZER)
    return digest_conversations(
        chat.format_turns(_conversations(spark, sf_dir), tokenizer), tokenizer
    )


def digest_conversations(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation of ``format_turns``, from its ids, mask and text alone.

    Turns are read back where they are. A digest takes them one by one, so what was read
    goes through one task per conversation, in order and without being held.
    """
    id_field = turns.schema["conv_id"]
    schema = T.StructType(
        [id_field, *T.StructType.fromDDL("position bigint, said binary, learned binary, chars bigint")]
    )
    result = T.StructType(
        [id_field, *T.StructType.fromDDL(
            "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
        )]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chat.slices(batches):
            found = chat.read_turns(batch.column("ids"), batch.column("loss_mask"), tokenizer)
            said, learned = [], []
            for role, text, under_mask in found:
                said.append(f"{role}\n{text}\n".encode())
                learned.append(under_mask.encode())
            chars = pc.utf8_length(batch.column("formatted")).cast(pa.int64())
            texts = [pa.array(x, pa.binary()) for x in (said, learned)]
            ids = [batch.column("conv_id"), batch.column("position")]
            yield pa.RecordBatch.from_arrays([*ids, *texts, chars], schema.names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        kinds = [to_arrow_type(f.dataType) for f in result.fields]

        def ended() -> tuple:
            n_turns, turns, loss_chars, loss, chars = state
            return current, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        def made(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, result.names)

        for batch in batches:
            rows = []
            for key, _, said, learned, size in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or key != current:
                    if state is not None:
                        rows.append(ended())
                    current = key
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(said)
                state[2] += len(learned.decode())
                state[3].update(learned)
                state[4] += size
            if rows:
                yield made(rows)
        if state is not None:
            yield made([ended()])

    placed = turns.mapInArrow(read, schema).repartition("conv_id")
    return placed.sortWithinPartitions("conv_id", "position").mapInArrow(digest, result)


_CONTROL = r"\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\]|\[/TURN\]"
_ESCAPED_SIZE = (
    "(length({0}) + length({0}) - length(replace({0}, chr(92), ''))"
    f" + len(regexp_extract_all({{0}}, '{_CONTROL}')))"
)

SQL["op10_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, {_ESCAPED_SIZE.format('text')} + CASE role
      WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
      ELSE 20 + {_ESCAPED_SIZE.format('role')} END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A NULL id has no remainder: such a row is neither learnt from nor held out.
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    prototypes = langid.learn(docs.where(remainder != 2))
    found = langid.predict(
        docs.select(F.struct("doc_id", remainder.eqNullSafe(2).alias("held_out")).alias("row"), "text"),
        prototypes,
        id_col="row",
    )
    return found.select("doc_id.doc_id", "doc_id.held_out", "lang_pred", "score")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with the faults that the contract plants by a checksum of their ids."""
    space = F.lit(" ")
    ids = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    case = F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(case == 1, "")
        .when(case == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(case == 0, 0).when(case == 3, 2).otherwise(1))),
    ).drop("col")


@query
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    told = [c for c in found.conversations.columns if c != "conv_id"]
    # One row per conversation from each; a conversation without turns has its id alone.
    numbers = [c for c in told if c != "audit"]
    whole = (
        ids.unionByName(found.conversations, allowMissingColumns=True)
        .unionByName(digest_turns(found.turns), allowMissingColumns=True)
        .groupBy("conv_id")
        .agg(*[F.max(c).alias(c) for c in (*told, "repaired_sha256")])
    )
    empty = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def digest_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of repaired turns: a digest needs them one by one, so a
    conversation goes through one task, in sorted order and without being held."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def result(rows: list[tuple]) -> pa.RecordBatch:
            keys, digests = zip(*rows)
            kind = to_arrow_type(schema["conv_id"].dataType)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array(digests, pa.string())], schema.names
            )

        for batch in batches:
            rows = []
            for key, role, text in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                if digest is None or key != current:
                    if digest is not None:
                        rows.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(role + b":" + text)
            if rows:
                yield result(rows)
        if digest is not None:
            yield result([(current, digest.hexdigest())])

    rows = turns.withColumns({c: F.col(c).cast("binary") for c in ("role", "text")})
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "n", "place")
    return placed.select("conv_id", "role", "text").mapInArrow(run, schema)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = vocabulary_path(align.A_RANKS), vocabulary_path(align.B_MODEL)
    aligned, links = align.aligned_with_counts(table(spark, sf_dir, "documents"), *paths)
    return digest_alignment(aligned, links, *paths)


def digest_alignment(
    aligned: DataFrame, links: align.Links, a_path: str, b_path: str
) -> DataFrame:
    """One row per document of ``align_tokenizers``; groups are spelled
    ``a1,a2|b1;a3|b2,b3`` and hashed."""
    known = aligned.sparkSession.sparkContext.broadcast(links)
    schema = keyed_schema(
        aligned,
        """n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,
        count_sum bigint, groups_sha256 string""",
    )

    def step(batch: pa.RecordBatch, tokens: dict[str, np.ndarray]) -> pa.RecordBatch:
        count, best = known.value.of(tokens)
        groups = align.groups_per_document(tokens)
        at = np.concatenate([[0], np.cumsum(groups)])
        sums = [np.diff(np.append(0, np.cumsum(x, dtype=np.int64))[at]) for x in (best, count)]
        texts = align.spelled_groups(tokens)
        digests = [hashlib.sha256(text).hexdigest() if text else "" for text in texts]
        arrays = [
            *[batch.column(name) for name in ("doc_id", "n_a", "n_b")],
            *[pa.array(x, pa.int64()) for x in (groups, groups, *sums)],
            pa.array(digests, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return align.map_tokens(aligned, schema, step, a_path, b_path)
