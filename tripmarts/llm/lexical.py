"""Ranked lexical search for many items at once, with shared parts of the items evaluated once.

Items are lists of terms, frequent terms first. Pairs of neighbours that several items have become
nodes, round by round, until no pair is shared: nodes are the term sets that items share, and each
is the sum of two others, so items and nodes form a graph. For a batch of documents every node has one
row of partial scores, computed once from its two parts, whatever the number of items that use it; an
item adds up the few nodes that are left of it.

Documents are read and tokenised once per block of items into postings of the block's terms, from which come
the counts of the corpus, then the scores. Tasks keep the best few of each item. Blocks of items are bounded in
terms, so what is broadcast is bounded, whatever the number of items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import stored, table
from tripmarts.llm.topk import LOWEST, NO_ID, Best

# What separates terms: ASCII other than letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Terms, repeats included, of the items that are evaluated in one pass over the documents.
BLOCK_TERMS = 1 << 16
# Bytes of texts tokenised at a time, partial scores held at a time.
TEXT_AT_A_TIME = 8 << 20
SCORES_AT_A_TIME = 1 << 22


def tokens(texts: pa.Array) -> pa.ListArray:
    """The terms of each text; some may be empty strings at its ends."""
    return pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)


def terms_of(text: str) -> list[str]:
    return [t for t in tokens(pa.array([text], pa.string())).to_pylist()[0] if t]


# --- the graph ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Graph:
    """Terms are nodes 0 .. len(terms) - 1; further nodes are sums of two. Items are sums of nodes."""

    terms: list[str]
    # For each round, the two parts of the nodes that it adds, in order.
    rounds: list[tuple[np.ndarray, np.ndarray]]
    # Nodes of all items one after the other, and where each item begins; no item is empty.
    nodes: np.ndarray
    starts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.terms) + sum(len(left) for left, _ in self.rounds)

    def totals(self, partial: np.ndarray) -> np.ndarray:
        """From rows of the terms (first rows of `partial`, which is filled up): a row for each item."""
        at = len(self.terms)
        for left, right in self.rounds:
            np.add(partial[left], partial[right], out=partial[at : at + len(left)])
            at += len(left)
        return np.add.reduceat(partial[self.nodes], self.starts, axis=0)


def proposed(item: list[int], rank: dict[tuple[int, int], int]) -> list[int]:
    """Places of neighbours to merge, the most shared first, none overlapping."""
    places = [(rank[pair], at) for at, pair in enumerate(zip(item, item[1:])) if pair in rank]
    taken, chosen = set(), []
    for _, at in sorted(places):
        if at not in taken and at + 1 not in taken:
            taken |= {at, at + 1}
            chosen.append(at)
    return chosen


def graph_of(items: list[list[str]]) -> Graph:
    """The graph of these items, none of them empty. The same for the same items in the same order."""
    held_by = Counter(term for item in items for term in set(item))
    names = sorted(held_by, key=lambda term: (-held_by[term], term))
    number = {term: place for place, term in enumerate(names)}
    lists = [sorted(number[term] for term in item) for item in items]
    size, rounds = len(names), []
    while True:
        shared = Counter(pair for item in lists for pair in set(zip(item, item[1:])))
        pairs = sorted((pair for pair, n in shared.items() if n > 1), key=lambda pair: (-shared[pair], pair))
        rank = {pair: place for place, pair in enumerate(pairs)}
        chosen = [proposed(item, rank) for item in lists]
        users = Counter(pair for item, places in zip(lists, chosen) for pair in {(item[at], item[at + 1]) for at in places})
        added = {pair: size + place for place, pair in enumerate(p for p in pairs if users[p] > 1)}
        if not added:
            break
        rounds.append(tuple(np.array(side) for side in zip(*added)))
        size += len(added)
        for row, places in enumerate(chosen):
            item = lists[row]
            for at in sorted(places, reverse=True):
                if (pair := (item[at], item[at + 1])) in added:
                    item[at : at + 2] = [added[pair]]
    sizes = [len(item) for item in lists]
    return Graph(names, rounds, np.array([n for item in lists for n in item]), np.cumsum([0, *sizes[:-1]]))


# --- the corpus ---------------------------------------------------------------------------------


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with at most TEXT_AT_A_TIME bytes of text, but for longer texts alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + TEXT_AT_A_TIME, "right")))
        yield batch.slice(at, to - at)
        at = to


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of each text with a term: all its terms counted, and those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for part in slices(batch):
                lists = tokens(pc.fill_null(part.column(1), ""))
                flat, offsets = lists.flatten(), lists.offsets.to_numpy()
                offsets = offsets - offsets[0]
                real = np.append(0, np.cumsum(pc.binary_length(flat).to_numpy() > 0))
                n = np.diff(real[offsets])
                number = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy()
                doc = np.repeat(np.arange(len(n)), np.diff(offsets))
                asked = number >= 0
                cells, counts = np.unique(doc[asked] * len(known) + number[asked], return_counts=True)
                edges = np.searchsorted(cells, np.arange(len(n) + 1) * len(known)).astype(np.int32)
                columns = [
                    part.column(0), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(edges, pa.array(cells % max(1, len(known)), pa.int32())),
                    pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64())),
                ]
                whole = pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])
                yield whole.filter(pa.array(n > 0))

    schema = "doc_id long, n long, terms array<int>, counts array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def document_counts(posted: DataFrame, size: int) -> np.ndarray:
    """For each term of the vocabulary, the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], names=["term", "df"])

    summed = posted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in summed.toLocalIterator():
        out[row["term"]] = row["df"]
    return out


def scored(posted: DataFrame, graph: Graph, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """(item, score, doc_id): the best `k` documents of each task for each item, by its place in the graph."""
    shared = posted.sparkSession.sparkContext.broadcast((graph, weights))
    at_once = max(1, min(1024, SCORES_AT_A_TIME // max(1, graph.size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = shared.value
        best = Best(len(graph.starts), k)
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                batch = whole.slice(at, at_once)
                ids = pc.fill_null(batch.column(0), NO_ID).to_numpy()
                m = np.array([75 + 25 * n * documents // length for n in batch.column(1).to_pylist()], np.int64)
                doc = np.repeat(np.arange(len(ids)), np.diff(batch.column(2).offsets.to_numpy()))
                term, count = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
                order = np.argsort(ids, kind="stable")
                column = np.empty(len(ids), np.int64)
                column[order] = np.arange(len(ids))
                partial = np.zeros((graph.size, len(ids)), np.int64)
                partial[term, column[doc]] = weights[term] * (1_000_000_000 * count // (1000 * count + 12 * m[doc]))
                totals = graph.totals(partial)
                totals[totals <= 0] = LOWEST
                best.add(0, totals, ids[order])
        item, score, ids = best.entries()
        columns = pa.array(item, pa.int64()), pa.array(score), pa.array(ids)
        yield pa.RecordBatch.from_arrays(list(columns), names=["item", "score", "doc_id"])

    return posted.mapInArrow(run, "item long, score long, doc_id long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` documents of `docs` (doc_id, text) that score best for each of `items`.

    Terms are runs of letters, digits and characters beyond ASCII, lower-cased in A-Z. The score
    sums, over the terms of the item with repeats, the term's weight times its saturated count in the
    document; scores are whole numbers and exact. Only scores above 0 rank; equal ones go by `doc_id`,
    none last. Null and empty texts have no term and no rank, as a document or as an item. Each row of `items`
    is an item of its own and each row of `docs` a document, with repeated or missing ids too. Columns
    beyond these two are not read. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    worded = stored(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("item", F.monotonically_increasing_id())
    )
    # At least as many terms as there are: each but the last is followed by a separator.
    total = worded.agg(F.sum(F.length("text") / 2 + 1).cast("long")).first()[0] or 0
    blocks = max(1, -(-total // (4 * BLOCK_TERMS)))
    found = [ranked_block(docs, worded.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k) for b in range(blocks)]
    found = [frame for frame in found if frame is not None]
    schema = "item_id long, rank int, doc_id long, score long"
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def ranked_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """The ranks of a bounded block of items."""
    spark = docs.sparkSession
    asked = [(row["item_id"], words) for row in items.orderBy("item").collect() if (words := terms_of(row["text"]))]
    if not asked:
        return None
    graph = graph_of([words for _, words in asked])
    posted = stored(postings(docs, graph.terms))
    documents, length = posted.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    held = document_counts(posted, len(graph.terms))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    best = scored(posted, graph, weights, documents, length, k).withColumn("rank", F.row_number().over(order))
    named = spark.createDataFrame([(place, item_id) for place, (item_id, _) in enumerate(asked)], "item long, item_id long")
    return best.filter(F.col("rank") <= k).join(named, "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"),
        F.nullif(F.col("doc_id"), F.lit(int(NO_ID))).alias("doc_id"), "score",
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH doc_terms AS (
    SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), item_terms AS (
    SELECT item_id, term, count(*) AS q FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL
), sizes AS (
    SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM doc_terms GROUP BY d
), corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
posted AS (
    SELECT d, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY d, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM posted, corpus GROUP BY term
), scores AS (
    SELECT item_id, d, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
    FROM item_terms JOIN posted USING (term) JOIN weights USING (term) JOIN sizes USING (d), corpus
    GROUP BY item_id, d
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN (SELECT d, doc_id FROM sizes) USING (d) WHERE score > 0
QUALIFY rank <= 20
"""
