"""Mixing sources to target weights by a curriculum that varies over training time.

Each source has a schedule: its weight at training time 0 to 1, linear between knots. The
integral of a schedule is the weight of its source and sets its target of words; a target stops at
`most_passes` times the source, and what it cannot use is reshared by weight. Within a source the
documents stand in a fixed random order, passed over as often as the target asks, the last document
cut. A copy whose first word is word u of its source is trained at the time at which the integrated
schedule has demanded u words (its inverse); copies are range-sorted by that time.

A source may hold most of the rows: running sums are taken within 4,096 hash buckets of each
source, after the sums of buckets, so no task gets a source. Only the table of sources, a row for
each, is ranked in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import let, stored, table, words_of

# The buckets of a source: the first hexadecimal digits of a document's ticket.
BUCKET_DIGITS = 3

Knots = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Curriculum:
    """Schedules, dealt to the sources in code point order, null last, and repeating."""

    schedules: tuple[Knots, ...] = field(
        default=(((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
    )
    share: float = 1.5
    most_passes: int = 2

    def pieces(self, number: int) -> list[tuple[float, float, float, float, float]]:
        """Start, end, weight at either, and the integral before the start, of each linear piece."""
        knots, before, out = self.schedules[number], 0.0, []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if t1 <= t0 or min(w0, w1) < 0:
                raise ValueError("knots need rising times and weights of zero or more")
            out.append((t0, t1, w0, w1, before))
            before += (t1 - t0) * (w0 + w1) / 2
        return out

    def weight(self, number: int) -> float:
        t0, t1, w0, w1, before = self.pieces(number)[-1]
        return before + (t1 - t0) * (w0 + w1) / 2


def with_size(docs: DataFrame, out: str = "size") -> DataFrame:
    """The number of words of each text; a null text has none."""
    return docs.withColumn(out, F.size(words_of(F.col("text"))).cast("long"))


def source_targets(sources: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """From (source, source_size): the schedule's number, weight and target of each source.

    In the order of size to weight, sources are full as long as an even share of what is left
    would exceed their limit; all others share the rest by weight.
    """
    everything = Window.partitionBy()
    number = (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(curriculum.schedules)
    weight = F.array(*[F.lit(float(curriculum.weight(i))) for i in range(len(curriculum.schedules))])
    ranked = (
        sources.select("source", "source_size", number.alias("number"))
        .withColumn("weight", weight[F.col("number")])
        .withColumn("limit", (F.col("source_size") * curriculum.most_passes).cast("double"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(curriculum.share)))
    )
    fullest = everything.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    onward = fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("wanted") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    shares = (
        ranked.withColumn("__left", left)
        .withColumn("__weights", F.sum("weight").over(onward))
        .withColumn("__full", F.col("weight") * F.col("__left") / F.col("__weights") >= F.col("limit"))
    )
    first = F.min(F.when(~F.col("__full"), F.struct(F.col("limit") / F.col("weight"), "__left", "__weights"))).over(everything)
    return (
        shares.withColumn("__open", first)
        .withColumn(
            "target",
            F.when(F.col("__full"), F.col("limit")).otherwise(
                F.col("weight") * F.col("__open.__left") / F.col("__open.__weights")
            ),
        )
        .select("source", "source_size", "number", "weight", "target")
    )


def time_of(word: Column, target: Column, number: Column, curriculum: Curriculum) -> Column:
    """The training time at which the integrated schedule has demanded `word` words of `target`."""

    def piece(values) -> Column:
        names = ("t0", "t1", "w0", "w1", "before")
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values)])

    pieces = F.array(*[F.array(*map(piece, curriculum.pieces(i))) for i in range(len(curriculum.schedules))])
    totals = F.array(*[F.lit(float(curriculum.weight(i))) for i in range(len(curriculum.schedules))])

    def within(asked: Column, p: Column) -> Column:
        rest = asked - p["before"]
        slope = (p["w1"] - p["w0"]) / (p["t1"] - p["t0"])
        root = F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * slope * rest, F.lit(0.0)))
        return F.when(rest <= 0, p["t0"]).otherwise(p["t0"] + 2 * rest / (p["w0"] + root))

    return let(
        word / target * totals[number],
        lambda asked: let(
            F.element_at(F.filter(pieces[number], lambda p: p["before"] <= asked), -1),
            lambda p: within(asked, p),
        ),
    )


def curriculum_plan(docs: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """Every row of `docs` (doc_id, source, size, others) with what the mix takes of it.

    Adds source_size, target, and `copies`: an array of (pass, words, position), one for each
    pass that takes words of the document, `words` being fewer than its size if it is cut.
    Documents without words are never taken. Order within a source: md5 of the id as text (null:
    empty), then id and size, so reruns agree; equal rows are interchangeable and stay apart. A null source is
    a source. A column of `docs` with one of the added names is replaced; others keep their values, whatever their names.
    """
    added = ("source_size", "target", "copies")
    kept = [c for c in docs.columns if c not in added]
    ticket = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = docs.select(
        "doc_id", "source", "size", F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), ticket.alias("__ticket"),
        F.conv(F.substring(ticket, 1, BUCKET_DIGITS), 16, 10).cast("int").alias("__bucket"),
    )
    sums = docs.groupBy("source", "__bucket").agg(F.sum("size").alias("__words"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("__words").alias("source_size")), curriculum)
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sums.withColumn("__before", F.coalesce(F.sum("__words").over(earlier), F.lit(0)))
        .join(targets.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of")))
        .select(F.col("source").alias("__of"), F.col("__bucket").alias("__in"), "__before", "source_size", "number", "target")
    )
    placed = docs.join(
        buckets, F.col("source").eqNullSafe(F.col("__of")) & (F.col("__bucket") == F.col("__in"))
    )
    inside = (
        Window.partitionBy("source", "__bucket").orderBy("__ticket", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumn(
        "__start", F.col("__before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )

    def copy(number: int) -> Column:
        start = F.col("__start") + number * F.col("source_size")
        words = F.least(F.col("size"), F.round("target").cast("long") - start)
        position = time_of(start.cast("double"), F.col("target"), F.col("number"), curriculum)
        return F.when(
            words > 0,
            F.struct(F.lit(number).alias("pass"), words.alias("words"), position.alias("position")),
        )

    return placed.withColumn(
        "copies", F.array_compact(F.array(*[copy(i) for i in range(curriculum.most_passes)]))
    ).select(*[F.col("row")[c].alias(c) for c in kept], *added)


def in_training_order(plan: DataFrame) -> DataFrame:
    """A row for each copy the mix takes, range-sorted by the time at which it is trained."""
    copies = plan.withColumn("copy", F.explode("copies")).drop("copies")
    return copies.orderBy("copy.position", F.col("source").asc_nulls_last(), "copy.pass", "doc_id")


def first_words(text: Column, count: Column) -> Column:
    """A text up to the end of its word number `count`."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), 1, count), "")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, sorted by the time at which the mix first takes it."""
    sizes = stored(with_size(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return (
        curriculum_plan(sizes)
        .select(
            "doc_id", "size", "source_size", "target", taken.alias("taken"),
            F.round(F.get("copies", F.lit(0))["position"], 9).alias("first_position"),
        )
        .orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
    )


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ticket
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 AS number
    FROM d GROUP BY source
), w AS (
    SELECT *, CASE number WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
           2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS wanted
    FROM s
), r AS (
    SELECT *,
           wanted - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM w
), f AS (
    SELECT *, weight * rest / weights >= most AS is_full FROM r
), o AS (
    SELECT rest AS open_rest, weights AS open_weights FROM f WHERE NOT is_full ORDER BY most / weight LIMIT 1
), t AS (
    SELECT source, source_size, number, weight,
           CASE WHEN is_full THEN most ELSE weight * open_rest / open_weights END AS target
    FROM f LEFT JOIN o ON TRUE
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.number,
           CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ticket, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
    SELECT *,
           greatest(least(size, CAST(round(target) AS BIGINT) - start), 0) AS first_words,
           greatest(least(size, CAST(round(target) AS BIGINT) - start - source_size), 0) AS second_words
    FROM p
), a AS (
    SELECT *, CASE number WHEN 0 THEN start::DOUBLE / target * 5.0::DOUBLE WHEN 1 THEN start::DOUBLE / target * 2.0::DOUBLE ELSE start::DOUBLE / target * 1.0::DOUBLE END AS asked
    FROM c
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(first_words + second_words AS BIGINT) AS taken,
       CASE WHEN first_words = 0 THEN NULL ELSE round(CASE
           WHEN number = 0 THEN CASE WHEN asked <= 0 THEN 0 ELSE 2 * asked / (7.5::DOUBLE + sqrt(greatest(56.25::DOUBLE - 10.0::DOUBLE * asked, 0))) END
           WHEN number = 1 THEN CASE WHEN asked <= 0 THEN 0 ELSE 2 * asked / (2.0::DOUBLE + sqrt(4.0::DOUBLE)) END
           WHEN asked < 0.375::DOUBLE THEN CASE WHEN asked <= 0 THEN 0 ELSE 2 * asked / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * asked)) END
           ELSE 0.5::DOUBLE + CASE WHEN asked <= 0.375::DOUBLE THEN 0 ELSE 2 * (asked - 0.375::DOUBLE) / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 2.0::DOUBLE * (asked - 0.375::DOUBLE))) END
       END, 9) END AS first_position
FROM a
"""
