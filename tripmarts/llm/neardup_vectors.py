"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on fixed random directions. In each projection the values are sorted, and
two vectors collide if one lies in the window centred on the other; pairs that collide often enough
are verified by their cosine in double precision. Window and count are calibrated on simulated
differences of exactly the least similarity, so that `recall` of such pairs pass; closer pairs collide more.

Work is dealt out by the first projection, cut into slabs so wide that pairs to be found lie in the
same slab or in neighbours (again by calibration), and slabs into blocks of bounded size: a task
compares two blocks. Equal vectors are one class. A task gives link counts for each class and links
enough to connect what it found, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import stored, table
from tripmarts.llm.components import components, stars

# Classes of a slab that are compared in one block.
BLOCK = 1024
# Pairs verified at a time.
PAIRS_AT_A_TIME = 1 << 14
SIMULATED = 20_000


@dataclass(frozen=True)
class Search:
    """What is found: cosines of at least `least`, with this share of the pairs just there."""

    least: float = 0.93
    projections: int = 24
    hit: float = 0.87
    recall: float = 0.99

    @lru_cache(maxsize=64)
    def plan(self, size: int) -> Plan:
        """Directions for vectors of this size, and what the simulation says about them."""
        rng = np.random.default_rng(size)
        directions = rng.standard_normal((size, self.projections + 1))
        directions /= np.linalg.norm(directions, axis=0)
        differences = rng.standard_normal((SIMULATED, size))
        differences *= np.sqrt(2 - 2 * self.least) / np.linalg.norm(differences, axis=1, keepdims=True)
        moved = np.abs(differences @ directions)
        lost = (1 - self.recall) / 2
        window = float(np.quantile(moved[:, 1:], self.hit))
        hits = (moved[:, 1:] <= window).sum(axis=1)
        return Plan(
            directions, float(np.quantile(moved[:, 0], 1 - lost)), window, max(1, int(np.quantile(hits, lost)))
        )


@dataclass(frozen=True)
class Plan:
    directions: np.ndarray
    slab: float
    window: float
    count: int


def collisions(a: np.ndarray, b: np.ndarray, window: float) -> np.ndarray:
    """How many projections (columns) of each row of `b` lie in the window centred on a row of `a`."""
    counts = np.zeros((len(a), len(b)), np.int8)
    rows = np.arange(len(a))
    for x, y in zip(a.T, b.T):
        order = np.argsort(y)
        ordered = y[order]
        steps = np.zeros((len(a), len(b) + 1), np.int8)
        steps[rows, np.searchsorted(ordered, x - window, "left")] += 1
        steps[rows, np.searchsorted(ordered, x + window, "right")] -= 1
        counts[:, order] += np.cumsum(steps[:, :-1], axis=1, dtype=np.int8)
    return counts


def matches(a: np.ndarray, b: np.ndarray, search: Search) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the pairs of unit vectors found."""
    plan = search.plan(a.shape[1])
    directions = plan.directions[:, 1:]
    counts = collisions(a @ directions, b @ directions, plan.window)
    x, y = np.nonzero(counts >= plan.count)
    good = np.empty(len(x), bool)
    for at in range(0, len(x), PAIRS_AT_A_TIME):
        part = slice(at, at + PAIRS_AT_A_TIME)
        good[part] = np.einsum("ij,ij->i", a[x[part]], b[y[part]]) >= search.least
    return x[good], y[good]


def slabs(pdf: pd.DataFrame, search: Search) -> pd.DataFrame:
    """Classes with their unit vector, its size and the slab of the first projection."""
    out = []
    for size, part in pdf.groupby(pdf["embedding"].map(len)):
        vectors = np.stack(part["embedding"].to_numpy()).astype(np.float64)
        # The largest component is made 1 first, so that no square leaves the range of doubles.
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        plan = search.plan(size)
        slab = np.floor(vectors @ plan.directions[:, 0] / plan.slab).astype(np.int32)
        out.append(part[["cid", "label", "copies"]].assign(size=size, slab=slab, unit=list(vectors)))
    return pd.concat(out)


def links_of_blocks(pdf: pd.DataFrame, search: Search) -> pd.DataFrame:
    """For each class with links in this pair of blocks: copies linked, and the least class connected."""
    first = (pdf["slab"] == pdf["slab1"]) & (pdf["own"] == pdf["own1"])
    sides = [pdf[first]]
    if (pdf["slab1"].iat[0], pdf["own1"].iat[0]) != (pdf["slab2"].iat[0], pdf["own2"].iat[0]):
        sides.append(pdf[~first])
    a, b = sides[0], sides[-1]
    if not len(a) or not len(b):
        return pd.DataFrame({"cid": [], "links": [], "root": []}, dtype="int64")
    x, y = matches(np.stack(a["unit"].to_numpy()), np.stack(b["unit"].to_numpy()), search)
    if len(sides) == 1:
        # The window is symmetric but for rounding at its ends, so either order may have been found.
        both = np.unique(np.minimum(x, y) * np.int64(len(a)) + np.maximum(x, y))
        x, y = both // len(a), both % len(a)
        x, y = x[x != y], y[x != y]
    ca, cb = a["cid"].to_numpy(), b["cid"].to_numpy()
    cids = np.concatenate([ca[x], cb[y]])
    copies = np.concatenate([b["copies"].to_numpy()[y], a["copies"].to_numpy()[x]])
    found, places = np.unique(cids, return_inverse=True)
    nodes, roots = stars(ca[x], cb[y])
    root = dict(zip(nodes.tolist(), roots.tolist()))
    links = np.zeros(len(found), np.int64)
    np.add.at(links, places, copies)
    return pd.DataFrame({
        "cid": found, "links": links,
        "root": np.array([root.get(c, c) for c in found.tolist()], np.int64),
    })


def class_links(classes: DataFrame, search: Search = Search(), block: int = BLOCK) -> DataFrame:
    """From classes (cid, label, copies, embedding): rows (cid, links, root), several for a class."""
    placed = stored(
        classes.mapInPandas(
            lambda parts: (slabs(pdf, search) for pdf in parts if len(pdf)),
            "cid long, label long, copies long, size int, slab int, unit array<double>",
        )
    )
    group = Window.partitionBy("label", "size").orderBy("slab")

    def blocks_of(step: int):
        """Blocks of the slab `step` further on; none if it is empty."""
        there = F.lag if step < 0 else F.lead
        return F.when(there("slab").over(group) == F.col("slab") + step, there("blocks").over(group))

    counted = (
        placed.groupBy("label", "size", "slab").agg(F.count("*").alias("n"))
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .select("label", "size", "slab", "blocks", blocks_of(-1).alias("earlier"), blocks_of(1).alias("later"))
    )
    dealt = placed.join(counted, ["label", "size", "slab"]).withColumn(
        "own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    )

    def pair(*blocks: Column) -> Column:
        names = ("slab1", "own1", "slab2", "own2")
        return F.struct(*[block.cast("int").alias(name) for block, name in zip(blocks, names)])

    slab, own = F.col("slab"), F.col("own")
    same = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: pair(slab, F.least(own, j), slab, F.greatest(own, j)),
    )
    before = F.transform(
        F.when(F.col("earlier") > 0, F.sequence(F.lit(0), F.col("earlier") - 1)), lambda j: pair(slab - 1, j, slab, own)
    )
    after = F.transform(
        F.when(F.col("later") > 0, F.sequence(F.lit(0), F.col("later") - 1)), lambda j: pair(slab, own, slab + 1, j)
    )
    nothing = F.slice(same, 1, 0)
    pairs = F.concat(same, F.coalesce(before, nothing), F.coalesce(after, nothing))
    return (
        dealt.select("label", "size", "slab", "own", "cid", "copies", "unit", F.explode(pairs).alias("p"))
        .select("label", "size", "slab", "own", "cid", "copies", "unit", "p.*")
        .groupBy("label", "size", "slab1", "own1", "slab2", "own2")
        .applyInPandas(lambda pdf: links_of_blocks(pdf, search), "cid long, links long, root long")
    )


def near_vectors(vectors: DataFrame, search: Search = Search()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null, their sizes are equal and their cosine is
    at least `search.least`. A null or empty vector, one of zeros, or one with a null, infinite or
    NaN component links with nothing and is its own component. Repeated rows are vectors of their
    own that link with each other. A row without an id counts as a link and gives no component its id.
    """
    numbers = F.col("embedding")
    finite = F.forall(numbers, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = F.coalesce(
        F.col("label").isNotNull() & (F.size(numbers) > 0) & finite & F.exists(numbers, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    ).withColumn("usable", usable)
    classes = stored(
        rows.filter("usable").groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    found = stored(class_links(classes.select("cid", "label", "copies", "embedding"), search))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    rooted = (
        classes.join(links, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    verdicts = rooted.join(named, "root").select(
        F.col("label").alias("__label"), F.col("embedding").alias("__embedding"), "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    linked = rows.filter("usable").join(
        verdicts, (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("__embedding"))
    ).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
