"""SimHash near-duplicates: fingerprints linked through BK-trees, then connected components.

Two 64-bit fingerprints within ``RADIUS`` (3) bits agree in at least one of four blocks of 16
bits. So each distinct fingerprint goes to four shards, one per block value, and each shard gets a
BK-tree. A shard with more than ``SHARD_ROWS`` fingerprints is dealt on: what agrees in one block
and differs in at most 3 of the other 48 bits agrees in one of four blocks of 12 of these. Trees
and the fingerprints that probe them meet by a shuffle on the shard instead of a broadcast of all
trees, because the trees grow with the corpus. A shard gives one link per fingerprint to the
smallest one it is connected with there, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import written
from medloom.llm.simhash import fingerprints

RADIUS = 3
SHINGLE_WORDS = 3
SHARD_ROWS = 256


class BKTree:
    """Numbers keyed by Hamming distance: a child's key is its distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the numbers at most ``radius`` bits away; follows edges in reach only."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            children = self.children[node]
            if children:
                todo += [children[k] for k in range(max(d - radius, 0), d + radius + 1) if k in children]
        return found

    def add(self, value: int) -> int:
        """Adds a number that is not in the tree yet; returns its place."""
        place = len(self.values)
        node = 0
        while place:
            d = (self.values[node] ^ value).bit_count()
            if d not in self.children[node]:
                self.children[node][d] = place
                break
            node = self.children[node][d]
        self.values.append(value)
        self.children.append({})
        return place


def linked(values: Iterable[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value it is connected with) for each value that is not the smallest."""
    tree, root = BKTree(), []

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for value in values:
        near = tree.within(value, radius)
        place = tree.add(value)
        root.append(place)
        for k in near:
            a, b = top(k), top(place)
            if a != b:
                low, high = (a, b) if tree.values[a] < tree.values[b] else (b, a)
                root[high] = low
    return [(tree.values[k], tree.values[top(k)]) for k in range(len(root)) if root[k] != k]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v`` (u > v): links that connect the distinct ``fingerprint`` values within the radius."""
    if radius > RADIUS:
        raise ValueError(f"four blocks find links of up to {RADIUS} bits")
    keyed = prints.select("fingerprint", F.inline(F.array(*[_block(b) for b in range(4)])))
    # Written (here and below), so that joins shuffle both sides and hot keys can be split.
    crowded = written(keyed.groupBy("shard").count().where(F.col("count") > SHARD_ROWS), "crowded")
    finer = [F.shiftrightunsigned("others", 12 * k).bitwiseAND(0xFFF) + (k + 1) * 4096 for k in range(4)]
    whole = F.array(F.lit(0).cast("bigint"))
    dealt = keyed.join(crowded, "shard", "left").select(
        "fingerprint", "shard", F.explode(F.when(F.col("count").isNull(), whole).otherwise(F.array(*finer))).alias("sub")
    )
    fields = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b[c].to_pylist() for c in ("shard", "sub", "fingerprint")]))
        out: list[tuple[int, int]] = []
        for _, group in groupby(rows, key=lambda r: r[:2]):
            out += linked((r[2] & (1 << 64) - 1 for r in group), radius)
            if len(out) >= 10_000:
                yield _batch(out, fields)
                out = []
        yield _batch(out, fields)

    return (
        dealt.repartition("shard", "sub")
        .sortWithinPartitions("shard", "sub", "fingerprint")
        .mapInArrow(run, "u long, v long")
        .distinct()
    )


def _block(b: int) -> Column:
    """The shard of one block of 16 bits, and the other 48 bits (turned so that they come low)."""
    fp, turn = F.col("fingerprint"), 16 * (b + 1) % 64
    turned = F.shiftrightunsigned(fp, turn).bitwiseOR(F.shiftleft(fp, 64 - turn)) if turn else fp
    own = F.shiftrightunsigned(fp, 16 * b).bitwiseAND(0xFFFF)
    return F.struct((own + b * 65536).alias("shard"), turned.alias("others"))


def _batch(rows: list[tuple[int, int]], fields: pa.Schema) -> pa.RecordBatch:
    signed = [[x - (1 << 64) if x >> 63 else x for x in column] for column in zip(*rows)] or [[], []]
    pairs = [(max(p), min(p)) for p in zip(*signed)]
    columns = zip(*pairs) if pairs else [[], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=fields)


def components(edges: DataFrame) -> DataFrame:
    """``u, root``: each linked node with the smallest node it is connected with, but for roots.

    Alternates two steps: each node hands its larger neighbours to the smallest one, then its
    smaller ones. Each round is written to the shared folder; only a count and a checksum come to
    the driver. Rounds grow with the logarithm of the longest path.
    """
    edges = written(edges, "links")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        handed = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = written(handed.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, **cols: str) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, a row per input row.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits.
    Null, empty and blank texts have fingerprint zero and are linked like any other; a null id
    takes part but is no component's id unless the component has no other. Repeated rows each give
    a row; other columns are not read; no input gives no rows.
    """
    prints = written(fingerprints(docs, shingle_words, **cols), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    rooted = _rooted(nodes, radius)
    least = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = written(rooted.join(least, "root").select("fingerprint", "component_id"), "named")
    return prints.join(named, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """The distinct fingerprints with ``root``, the smallest one each is connected with."""
    roots = components(links(nodes.select("fingerprint"), radius)).withColumnRenamed("u", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    return written(rooted, "rooted")


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, with all columns of the input, whatever their names.

    It has the smallest id; null ids come last. Of rows with this id the least text checksum decides,
    and of rows that repeat id and text one stays. Null, empty and blank texts are one component
    (with texts within the radius of fingerprint zero); no input gives no rows.
    """
    checksum = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), checksum.alias("sum"))
    prints = written(fingerprints(keyed, shingle_words, carry=["sum"]), "fingerprints")
    rows = prints.groupBy("fingerprint", "doc_id", F.col("carried.sum").alias("sum")).agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sum", "n")).alias("first")
    rooted = _rooted(written(rows.groupBy("fingerprint").agg(first), "firsts"), radius)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first"))
    kept = written(kept.select(F.col("first.doc_id").alias("kept_id"), "first.sum", "first.n"), "kept")
    held = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_col).cast("bigint").alias("held_id"), checksum.alias("held_sum")
    )
    same = F.col("held_id").eqNullSafe(F.col("kept_id")) & (F.col("held_sum") == F.col("sum"))
    single = held.join(kept.where("n = 1"), same, "left_semi")
    repeated = held.join(kept.where("n > 1"), same).dropDuplicates(["held_id", "held_sum"])
    return single.select("row.*").unionByName(repeated.select("row.*"))
