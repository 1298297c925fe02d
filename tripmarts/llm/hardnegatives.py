"""Hard negatives by slots: for each anchor and positive, the best rows of other labels in a score window.

The windows of an anchor's positives overlap: each reaches from a share of the positive's score up to
that score. Their upper limits cut the scores into disjoint slots, the highest first, so every score falls in one.
Tasks compare a block of anchors with a group of rows and keep the best few of each slot, which is all
that leaves them; the few of all tasks meet per anchor and slot. A window is its own slot followed by
the window below, so one pass over the slots, lowest first, merges the answers of all of them.

Scores are whole inner products, exact: sums below 2^53 by matrix products of doubles, others by
whole numbers without bound (kept within +-2^62). Each pair of an anchor and a row is scored once to find
positives, if the labels are equal, and once to find negatives. Blocks of anchors and groups of rows are
bounded, so the rows that are shuffled grow with rows x anchors / block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import discard, stored, table
from tripmarts.llm.topk import HIGHEST, LOWEST, NO_ID, Best

# Anchors of a block and rows of a group: what a task holds, and what streams past it.
BLOCK = 1 << 14
GROUP = 1 << 20
# Groups are made smaller, down to this, while tasks would be idle.
LEAST_GROUP = 1 << 9
# Scores computed at a time: anchors x rows.
ANCHORS_AT_A_TIME = 256
ROWS_AT_A_TIME = 2048


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and the least share of the positive's score in hundredths."""

    positives: int = 5
    negatives: int = 5
    least: int = 80
    # Components are multiplied by this and rounded down.
    scale: int = 256


def rectangle(column: pa.ListArray, scale: int) -> np.ndarray:
    """Vectors as rows of whole numbers, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy() * scale)
    width = int(sizes.max(initial=0))
    if len(flat) == len(sizes) * width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of both, exact; missing components count as zero."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object) for side in (a, b)]
    return np.clip(whole[0] @ whole[1].T, LOWEST + 1, HIGHEST - 1).astype(np.int64)


class Anchors:
    """A block of anchors with the best rows found so far in each slot."""

    def __init__(self, numbers, ids, labels, vectors, limits: list[list[int]], k: int, least: int, alike: bool):
        self.numbers, self.ids, self.labels, self.vectors, self.alike = numbers, ids, labels, vectors, alike
        slots = max((len(x) for x in limits), default=0)
        self.upper = np.full((len(limits), slots + 1), LOWEST)
        self.lower = np.full((len(limits), slots), LOWEST + 1)
        for row, upper in enumerate(limits):
            self.upper[row, : len(upper)] = upper
            if not alike:
                self.lower[row, : len(upper)] = [-(-least * x // 100) for x in upper]
        self.best = [Best(len(limits), k) for _ in range(slots)]

    def compare(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        for start in range(0, len(ids), ROWS_AT_A_TIME):
            some = order[start : start + ROWS_AT_A_TIME]
            for at in range(0, len(self.ids), ANCHORS_AT_A_TIME):
                these = slice(at, at + ANCHORS_AT_A_TIME)
                scores = products(self.vectors[these], vectors[some])
                same = self.labels[these, None] == labels[some]
                fits = (same if self.alike else ~same) & (self.ids[these, None] != ids[some])
                for slot, best in enumerate(self.best):
                    inside = fits & (scores <= self.upper[these, slot, None]) & (scores >= self.lower[these, slot, None])
                    inside &= scores > self.upper[these, slot + 1, None]
                    best.add(at, np.where(inside, scores, LOWEST), ids[some])

    def found(self) -> Iterator[pa.RecordBatch]:
        for slot, best in enumerate(self.best):
            row, scores, ids = best.entries()
            columns = self.numbers[row], np.full(len(row), slot, np.int32), scores, ids
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "slot", "score", "id"])


def best_of_slots(anchors: DataFrame, rows: DataFrame, k: int, mining: Mining, alike: bool) -> DataFrame:
    """(anchor, slot, score, id): for each anchor and slot, the best `k` rows with its label (`alike`) or another.

    `anchors` (part, blocks, groups, anchor, id, label, vector, limits) are compared with the
    `rows` (part, blocks, groups, row, id, label, vector) of the same part.
    """
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, block = None, [], None
        for batch in batches:
            where = [batch.column(name).to_numpy() for name in ("part", "block", "group", "streams")]
            changes = np.any([x[1:] != x[:-1] for x in where], axis=0) if batch.num_rows else np.empty(0, bool)
            cuts = np.concatenate([[0], np.flatnonzero(changes) + 1, [batch.num_rows]])
            for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if first == last:
                    continue
                here = tuple(x[first] for x in where[:3])
                if here != cell:
                    if block:
                        yield from block.found()
                    cell, waiting, block = here, [], None
                piece = batch.slice(first, last - first)
                ids, labels = (piece.column(name).to_numpy() for name in ("id", "label"))
                vectors = rectangle(piece.column("vector"), mining.scale)
                if not where[3][first]:
                    limits = piece.column("limits").to_pylist()
                    waiting.append((piece.column("anchor").to_numpy(), ids, labels, vectors, limits))
                    continue
                if waiting and block is None:
                    numbers, own, named, vector_parts, limits = zip(*waiting)
                    block = Anchors(
                        np.concatenate(numbers), np.concatenate(own), np.concatenate(named), stacked(vector_parts),
                        [x for part in limits for x in part], k, mining.least, alike,
                    )
                if block:
                    block.compare(ids, labels, vectors)
        if block:
            yield from block.found()

    def upto(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    held = anchors.select(
        "part", F.pmod(F.xxhash64("anchor"), "blocks").alias("block"), upto("groups").alias("group"),
        F.lit(0).alias("streams"), "anchor", "id", "label", "vector", "limits",
    )
    streamed = rows.select(
        "part", upto("blocks").alias("block"), F.pmod(F.xxhash64("row"), "groups").alias("group"),
        F.lit(1).alias("streams"), F.lit(0).cast("long").alias("anchor"), "id", "label", "vector",
        F.array().cast("array<long>").alias("limits"),
    )
    few = (
        held.union(streamed)
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part", "block", "group")
        .sortWithinPartitions("part", "block", "group", "streams")
        .mapInArrow(run, "anchor long, slot int, score long, id long")
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def sized(anchors: Column, rows: Column, partitions: int) -> list[Column]:
    """How many blocks and groups so many anchors and rows are dealt to."""
    blocks = F.greatest(F.ceil(anchors / BLOCK), F.lit(1))
    wanted = F.ceil(F.lit(3 * partitions) / blocks)
    groups = F.greatest(F.ceil(rows / GROUP), F.least(wanted, F.ceil(rows / LEAST_GROUP)))
    return [blocks.cast("long").alias("blocks"), groups.cast("long").alias("groups")]


def hard_negatives(vectors: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, embedding).

    The positives of an anchor are the best rows of its label, its negatives the best rows of
    another label with `least` hundredths of the positive's score to all of it. Equal scores go by
    `vec_id`, none last. Rows with a null label or vector, or with a component that is null or
    not finite once scaled, take no part. Other rows are those with another `vec_id`; repeated rows count
    as often as they occur, and each is an anchor of its own. Vectors of different sizes are compared on the
    components that both have; empty ones score 0. An anchor without positives, a positive without
    negatives and an empty table give no rows. Columns beyond these three are not read.
    """
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scaled = F.col("vector")
    usable = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * mining.scale) < float("inf")))
    rows = stored(
        vectors.select(
            F.coalesce(F.col("vec_id").cast("long"), F.lit(int(NO_ID))).alias("id"), F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
        .filter(F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
        .withColumn("row", F.monotonically_increasing_id())
    )
    counts = F.sum(F.col("is_anchor").cast("long")).alias("anchors"), F.count("*").alias("rows")
    per_label = stored(
        rows.groupBy("label").agg(*counts).filter("anchors > 0")
        .select(F.col("label").alias("part"), *sized(F.col("anchors"), F.col("rows"), partitions))
    )
    with_label = rows.join(per_label, F.col("label") == F.col("part"))
    no_limit = F.array(F.lit(HIGHEST - 1)).alias("limits")
    of_label = with_label.filter("is_anchor").select("*", F.col("row").alias("anchor"), no_limit)
    positives = (
        best_of_slots(of_label, with_label, mining.positives, mining, alike=True)
        .groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))).alias("positives"))
    )
    total = rows.agg(*counts).select(F.lit(0).cast("long").alias("part"), *sized(F.col("anchors"), F.col("rows"), partitions)).first()
    whole = [F.lit(total[name]).cast("long").alias(name) for name in ("blocks", "groups")]
    part = F.lit(0).cast("long").alias("part")
    anchors = stored(
        rows.filter("is_anchor").withColumnRenamed("row", "anchor").join(positives, "anchor")
        .select("*", F.transform("positives", lambda p: -p["down"]).alias("limits"))
    )
    discard(per_label)
    found = best_of_slots(
        anchors.select("*", part, *whole), rows.select("*", part, *whole), mining.negatives, mining, alike=False
    ).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("slots")
    )

    def window(done: Column, slot: Column) -> Column:
        """The windows so far, the last one first, with that of the slot above put before them."""
        own = F.filter("slots", lambda x: x["slot"] == slot)
        below = F.coalesce(F.get(done, F.lit(0)), F.slice(F.col("slots"), 1, 0))
        return F.concat(F.array(F.slice(F.concat(own, below), 1, mining.negatives)), done)

    lowest_first = F.sequence(F.size("positives") - 1, F.lit(0), F.lit(-1))
    none = F.slice(F.array(F.col("slots")), 1, 0)
    windows = F.aggregate(lowest_first, none, window)
    pairs = (
        anchors.select("anchor", F.col("id").alias("anchor_id"), "positives").join(found, "anchor")
        .select("anchor_id", F.posexplode(F.arrays_zip(F.col("positives"), windows.alias("negatives"))).alias("at", "pair"))
        .select("anchor_id", F.col("pair.positives").alias("p"), F.col("pair.negatives").alias("n"))
    )
    exact = "decimal(38,0)"
    high_enough = F.filter("n", lambda n: -n["down"].cast(exact) * 100 >= -F.col("p.down").cast(exact) * mining.least)

    def named(number: Column) -> Column:
        return F.nullif(number, F.lit(int(NO_ID)))

    return pairs.select("anchor_id", "p", F.posexplode(high_enough).alias("place", "n")).select(
        "anchor_id", named(F.col("p.id")).alias("positive_id"), (F.col("place") + 1).cast("int").alias("rank"),
        named(F.col("n.id")).alias("negative_id"), (-F.col("p.down")).alias("positive_score"),
        (-F.col("n.down")).alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
               PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
