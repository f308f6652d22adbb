"""SimHash near-duplicates through vantage-point trees.

A fingerprint has a bit set where more than half of the hashes of the text's
shingles have it. Equal fingerprints are one point. A top tree, built from a
bounded sample, splits all points by their Hamming distance from vantage points;
each leaf is a shard. A point within ``max_bits`` of a split's border belongs to
one side and visits the other, so by the triangle inequality every close pair
meets in the later of its two shards. A shard builds a tree of its own over its
members and asks it for every member and visitor. The sample decides how even
the shards are, never which pairs are found.

Close points of a shard are joined there into trees of links, so no group is ever
spelled out in pairs; components of the links give the result.

Defined results: a NULL or empty text has fingerprint zero, linked like any
other; the class id is the smallest id that is not NULL (NULL if there is none);
ids may be of any orderable type and repeat; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import as_bytes, columns, join_counted, keyed_schema, map_batches, written
from reviewloom.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SAMPLE_POINTS = 100_000  # a bound on what the top tree is fitted to
SAMPLE_SHARE = 16  # and one point in so many at most
SHARD_POINTS = 32_768
BUCKET = 64  # points of a shard's tree compared one by one
CHUNK = 1 << 21  # comparisons held at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*[words[i:] for i in range(shingle)])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], "<u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``doc_id, point``: the fingerprint as a signed 64-bit number."""
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            points = pa.array(np.array(found, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([batch.column(0), points], ["doc_id", "point"])

        return step

    return map_batches(docs, keyed_schema(docs, "point bigint"), make)


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


@dataclass
class Node:
    """Points within ``radius`` of ``vantage`` are inside, the others outside."""

    vantage: np.uint64 | None = None
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None
    leaf: int = -1
    members: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def build(points: np.ndarray, most: int) -> tuple[Node, int]:
    """A tree whose leaves hold ``most`` of the points, more only if they cannot be told apart."""
    leaves = 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal leaves
        if len(rows) > most:
            # Of a few candidates the one that splits most evenly.
            best = None
            for candidate in rows[:: max(1, len(rows) // 5)][:5]:
                away = distances(points[rows], points[candidate])
                radius = int(np.sort(away)[(len(away) - 1) // 2])
                for at in (radius - 1, radius):
                    inner = int((away <= at).sum())
                    uneven = abs(2 * inner - len(rows))
                    if 0 < inner < len(rows) and (best is None or uneven < best[0]):
                        best = (uneven, points[candidate], at, away <= at)
            if best:
                _, vantage, radius, inner = best
                return Node(vantage, radius, grow(rows[inner]), grow(rows[~inner]))
        leaves += 1
        return Node(leaf=leaves - 1, members=rows)

    return grow(np.arange(len(points))), leaves


def visits(node: Node, points: np.ndarray, rows: np.ndarray, reach: int) -> Iterator[tuple]:
    """(leaf node, rows of points at home there, rows of points that only come close)."""
    yield from _visits(node, points, rows, np.zeros(0, np.int64), reach)


def _visits(node, points, home, guests, reach):
    if node.vantage is None:
        yield node, home, guests
        return
    away, near = distances(points[home], node.vantage), distances(points[guests], node.vantage)
    inside = away <= node.radius
    # Within ``reach`` of the border: may be close to a point on the other side.
    into = away <= node.radius + reach
    out = away > node.radius - reach
    guests_in, guests_out = near <= node.radius + reach, near > node.radius - reach
    if len(home) or len(guests):
        yield from _visits(
            node.inside, points, home[inside],
            np.concatenate([home[into & ~inside], guests[guests_in]]), reach,
        )
        yield from _visits(
            node.outside, points, home[~inside],
            np.concatenate([home[out & inside], guests[guests_out]]), reach,
        )


class Union:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def close_links(members: np.ndarray, guests: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """A forest of links that joins every two points, one a member, ``reach`` bits apart."""
    points = np.concatenate([members, guests])
    tree, _ = build(members, BUCKET)
    union, links = Union(), []
    for leaf, home, near in visits(tree, points, np.arange(len(points)), reach):
        asking = np.concatenate([home, near])
        held = points[leaf.members]
        if not len(held):
            continue
        step = max(1, CHUNK // len(held))
        for start in range(0, len(asking), step):
            some = asking[start : start + step]
            apart = np.bitwise_count(points[some][:, None] ^ held[None, :])
            for i, j in zip(*np.nonzero(apart <= reach)):
                x, y = int(some[i]), int(leaf.members[j])
                if x != y and union.join(x, y):
                    links.append((int(points[x]), int(points[y])))
    return links


def near_links(points: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links ``a, b`` between distinct points that connect all pairs ``max_bits`` apart."""
    spark = points.sparkSession
    count = points.count()
    # Every k-th hash value: a bounded sample of distinct points, never all of them.
    k = max(SAMPLE_SHARE, -(-count // SAMPLE_POINTS))
    sample = points.where(F.pmod(F.xxhash64("point"), F.lit(k)) == 0).toArrow().column(0)
    sample = np.sort(np.asarray(sample).astype(np.int64)).view(np.uint64)
    sample = np.random.default_rng(SEED).permutation(sample)
    top, shards = build(sample, max(1, shard_points * len(sample) // max(1, count)))
    sent = spark.sparkContext.broadcast(top)

    def make():
        def route(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = np.asarray(batch.column(0)).view(np.uint64)
            home = np.zeros(len(own), np.int64)
            rows, leaves = [], []
            for leaf, at_home, near in visits(sent.value, own, np.arange(len(own)), max_bits):
                home[at_home] = leaf.leaf
                rows.append(near)
                leaves.append(np.full(len(near), leaf.leaf))
            rows, leaves = np.concatenate(rows), np.concatenate(leaves)
            later = leaves > home[rows]  # a pair meets in the later shard
            shard = np.concatenate([home, leaves[later]])
            point = np.concatenate([own, own[rows[later]]]).view(np.int64)
            guest = np.concatenate([np.zeros(len(own), bool), np.ones(int(later.sum()), bool)])
            return pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(point), pa.array(guest)], ["shard", "point", "guest"]
            )

        return route

    def link(table: pa.Table) -> pa.Table:
        guest = np.asarray(table.column("guest"))
        point = np.asarray(table.column("point")).view(np.uint64)
        found = close_links(point[~guest], point[guest], max_bits)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    routed = map_batches(points, "shard bigint, point bigint, guest boolean", make, rows=None)
    return routed.groupBy("shard").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """Per document: ``doc_id, point`` and ``component_id``, the smallest id of its class."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    points = written(
        rows.groupBy("point").agg(F.min("doc_id").alias("least"), F.count("*").alias("docs")),
        "points",
    )
    linked = components(near_links(points.select("point"), max_bits, shard_points))
    classes = points.join(linked, points["point"] == linked["node"], "left").select(
        "point", "least", "docs", "root"
    )
    alone = classes.where(F.col("root").isNull() & (F.col("docs") > 1))
    joint = classes.where(F.col("root").isNotNull())
    smallest = joint.groupBy("root").agg(F.min("least").alias("component_id"))
    # Only points of several documents need their class looked up.
    known = alone.select("point", "docs", F.col("least").alias("component_id")).union(
        joint.join(smallest, "root").select("point", "docs", "component_id")
    )
    known = written(known.withColumn("several", F.lit(True)), "classes")
    return join_counted(rows, known, "point", "docs", "left").select(
        "doc_id",
        "point",
        F.when(F.col("several"), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
