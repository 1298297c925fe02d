"""Connected components of a graph too large for one machine, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import discard, stored

# Links that a task contracts at a time; bounds its memory to some tens of megabytes.
LINKS_AT_A_TIME = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of these links, but for the roots, with the smallest node it is connected to."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        lower = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], lower)
        np.minimum.at(new, label[y], lower)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of this partition, replaced by fewer that connect the same nodes."""

    def flush(held: list) -> pa.RecordBatch:
        a, b = stars(*(np.concatenate(side) for side in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= LINKS_AT_A_TIME:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def components(links: DataFrame) -> DataFrame:
    """From links (a, b), both long and not null: (node, root) for each node that is not a root.

    The root of a component is its smallest node. Alternates large and small stars, which
    converge in a number of rounds that grows with the logarithm of the nodes; each round joins
    every link with the smallest neighbour of its end, which is pre-aggregated. The links of one node stream
    through one task of that join, in bounded memory; before each round partitions contract their own
    links, which leaves fewer. So a hub of a very large component makes one task long. (Storing the smallest
    neighbours would let the join be split, at four small writes a round instead of one.)
    """

    def contract(frame: DataFrame) -> DataFrame:
        return frame.mapInArrow(contracted, "a long, b long").distinct()

    def reached(frame: DataFrame, lowest: DataFrame) -> DataFrame:
        return frame.join(lowest.withColumnRenamed("a", "__at"), F.col("a") == F.col("__at"))

    def large(frame: DataFrame) -> DataFrame:
        both = frame.union(frame.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("__low"))
        found = reached(both.filter("b > a"), lowest)
        return found.select(F.col("b").alias("a"), F.col("__low").alias("b")).filter("a <> b")

    def small(frame: DataFrame) -> DataFrame:
        down = frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("__low"))
        sideways = reached(down, lowest).select(F.col("b").alias("a"), F.col("__low").alias("b"))
        return sideways.filter("a <> b").union(lowest.select("a", F.col("__low").alias("b")))

    def state(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    now = stored(contract(links.filter("a <> b")))
    before = state(now)
    while before[0]:
        then = stored(contract(small(large(now))))
        after = state(then)
        discard(now)
        now = then
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
