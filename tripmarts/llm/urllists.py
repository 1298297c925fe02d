"""URL filters with dated lists: entries become validity intervals, captures join as of their fetch.

A list says when a pattern (a host, a domain above it, or a host with leading path segments) was
added or removed. Its changes become disjoint intervals, from inclusive, until exclusive. A capture
is judged by the entries that were active when it was fetched, not by today's list: an equi-join
on the pattern with the interval as its condition, after captures were reduced to distinct (url,
time). The longest matching pattern decides; of equal ones, an allowing entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import let, table

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The lower-cased host, without a final dot; null where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")
    return F.when(host != "", host)


def patterns_of(url: Column, sizes: Column) -> Column:
    """The patterns that match a URL and that a list may hold: its host, the domains above it, its host with path prefixes.

    `sizes` has the numbers of labels and of path segments that occur in the list (`labels`, `steps`), so a URL of
    very many segments makes no more patterns than the list has sizes.
    """
    host = host_of(url)
    return let(
        F.struct(
            F.split(host, r"\.").alias("labels"),
            F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "").alias("steps"),
        ),
        lambda u: F.when(
            host.isNotNull(),
            F.array_distinct(
                F.concat(
                    F.transform(
                        F.filter(sizes["labels"], lambda n: n <= F.size(u["labels"])),
                        lambda n: F.array_join(F.slice(u["labels"], F.size(u["labels"]) - n + 1, n), "."),
                    ),
                    F.transform(
                        F.filter(sizes["steps"], lambda n: n <= F.size(u["steps"])),
                        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(u["steps"], 1, n), "/")),
                    ),
                )
            ),
        ),
    )


def sizes_in(intervals: DataFrame) -> Column:
    """The numbers of labels of listed hosts and domains, and of segments of listed paths, as one scalar."""
    path = F.contains("pattern", F.lit("/"))
    labels = F.when(~path, F.size(F.split("pattern", r"\.")))
    steps = F.when(path, F.size(F.split("pattern", "/")) - 1)
    return intervals.agg(F.collect_set(labels).alias("labels"), F.collect_set(steps).alias("steps")).select(
        F.struct("labels", "steps").alias("sizes")
    ).scalar()


def validity_intervals(changes: DataFrame) -> DataFrame:
    """From (list, pattern, allows, at, added): (list, pattern, allows, valid_from, valid_until).

    `added` is false for a removal. Of changes at the same moment a removal counts last. An
    addition of what is listed, or a removal of what is not, changes nothing. The last interval
    is open (null). Rows with a null pattern, moment or `added` are no changes; a null `allows` is false.
    """
    known = changes.filter("pattern IS NOT NULL AND at IS NOT NULL AND added IS NOT NULL")
    entry = ["list", "pattern", "allows"]
    moments = (
        known.withColumn("allows", F.coalesce("allows", F.lit(False)))
        .groupBy(*entry, "at").agg(F.min("added").alias("added"))
    )
    order = Window.partitionBy(*entry).orderBy("at")
    turns = moments.withColumn("was", F.coalesce(F.lag("added").over(order), F.lit(False))).filter("added <> was")
    return (
        turns.withColumn("valid_until", F.lead("at").over(order))
        .filter("added")
        .select(*entry, F.col("at").alias("valid_from"), "valid_until")
    )


def judge(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """Each row of `captures` (url, fetched, others) with host, n_active, blocked, list and pattern.

    n_active counts the entries active at the fetch that match; list and pattern are those of the
    deciding one, null if there is none. Captures without a host or a time match nothing and are not
    blocked. Repeated rows stay apart. A column of `captures` with an added name is replaced; others keep their
    values, whatever their names. A URL of any length asks only for patterns of sizes that the list has.
    """
    added = ("host", "n_active", "blocked", "list", "pattern")
    rest = [c for c in captures.columns if c not in added]
    captures = captures.select("url", "fetched", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    distinct = captures.select("url", "fetched").filter("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    sized = distinct.withColumn("sizes", sizes_in(intervals))
    asked = sized.select("url", "fetched", F.explode(patterns_of(F.col("url"), F.col("sizes"))).alias("asked"))
    active = (F.col("asked") == F.col("pattern")) & (F.col("fetched") >= F.col("valid_from")) & (
        F.col("valid_until").isNull() | (F.col("fetched") < F.col("valid_until"))
    )
    # Greater is stronger: longer pattern, then allowing; list and pattern settle what is left.
    strength = F.struct(F.length("pattern"), "allows", "list", "pattern")
    verdicts = (
        asked.join(intervals, active)
        .groupBy("url", "fetched")
        .agg(F.count("*").alias("n_active"), F.max(strength).alias("best"))
        .select(F.col("url").alias("of_url"), F.col("fetched").alias("of_fetched"), "n_active", "best")
    )
    judged = captures.join(verdicts, (F.col("url") == F.col("of_url")) & (F.col("fetched") == F.col("of_fetched")), "left")
    return judged.select(
        *[F.col("row")[c].alias(c) for c in rest], host_of(F.col("url")).alias("host"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"), F.coalesce(~F.col("best.allows"), F.lit(False)).alias("blocked"),
        F.col("best.list").alias("list"), F.col("best.pattern").alias("pattern"),
    )


def number(text: Column, first: int, digits: int) -> Column:
    """A number drawn from a text: some digits of its md5."""
    return F.conv(F.substring(F.md5(text), first, digits), 16, 10).cast("int")


def derived_changes(pages: DataFrame) -> DataFrame:
    """Dated list changes made from the hosts of the pages: no dated list comes with the tables.

    Six of 16 hosts are blocked from some day, most for 60 days, some again 60 days later; domains above
    hosts are allowed for 3 of 16; 4 of 16 first path segments are blocked.
    """
    url = F.col("url")
    hosts = pages.select(host_of(url).alias("pattern")).filter("pattern IS NOT NULL").distinct()
    draw = F.col("pattern")
    day = number(draw, 2, 2)

    def change(name: str, allows: bool, on: Column, added: bool, chosen: Column) -> Column:
        return F.when(
            chosen,
            F.struct(
                F.lit(name).alias("list"), F.lit(allows).alias("allows"),
                F.date_add(F.lit("2024-01-01").cast("date"), on).alias("at"), F.lit(added).alias("added"),
            ),
        )

    def listed(frame: DataFrame, *changes: Column) -> DataFrame:
        found = frame.select("pattern", F.explode(F.array_compact(F.array(*changes))).alias("c"))
        return found.select("pattern", "c.*")

    blocked = number(draw, 1, 1) < 6
    domains = hosts.select(F.regexp_extract("pattern", r"^[^.]+\.(.+\..+)$", 1).alias("pattern")).filter("pattern <> ''").distinct()
    first = F.regexp_extract(url, r"^[^:]+://[^/?#]*/([^/?#]+)", 1)
    sections = pages.select(F.concat(host_of(url), F.lit("/"), first).alias("pattern")).filter("pattern NOT LIKE '%/'").distinct()
    return (
        listed(
            hosts,
            change("spam", False, day, True, blocked),
            change("spam", False, day + 60, False, blocked & (number(draw, 4, 1) < 12)),
            change("spam", False, day + 120, True, blocked & (number(draw, 5, 1) < 4)),
        )
        .unionByName(listed(domains, change("trusted", True, day, True, number(draw, 1, 1) < 3)))
        .unionByName(listed(sections, change("sections", False, day, True, number(draw, 1, 1) < 4)))
    )


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    seed = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), number(seed, 1, 4) % 366))
    return judge(captures, validity_intervals(derived_changes(pages))).select(
        "page_id", "fetched", "host", "n_active", "blocked", "list", "pattern"
    )


OP2_SQL = r"""
WITH p AS (
    SELECT page_id, url,
           DATE '2024-01-01' + CAST(('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 4))::INTEGER % 366 AS INTEGER) AS fetched,
           nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)', 1)), '\.$', ''), '') AS host,
           list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS steps,
           regexp_extract(url, '^[^:]+://[^/?#]*/([^/?#]+)', 1) AS first
    FROM pages
), h AS (
    SELECT DISTINCT host AS pattern FROM p WHERE host IS NOT NULL
), draws AS (
    SELECT 'h' AS kind, pattern FROM h
    UNION ALL SELECT DISTINCT 'd', regexp_extract(pattern, '^[^.]+\.(.+\..+)$', 1) FROM h WHERE regexp_extract(pattern, '^[^.]+\.(.+\..+)$', 1) <> ''
    UNION ALL SELECT DISTINCT 's', host || '/' || first FROM p WHERE host IS NOT NULL AND first <> ''
), n AS (
    SELECT kind, pattern, ('0x' || substr(md5(pattern), 1, 1))::INTEGER AS one, ('0x' || substr(md5(pattern), 2, 2))::INTEGER AS day,
           ('0x' || substr(md5(pattern), 4, 1))::INTEGER AS four, ('0x' || substr(md5(pattern), 5, 1))::INTEGER AS five
    FROM draws
), i AS (
    SELECT 'spam' AS list, pattern, FALSE AS allows, DATE '2024-01-01' + day AS valid_from,
           CASE WHEN four < 12 THEN DATE '2024-01-01' + day + 60 END AS valid_until
    FROM n WHERE kind = 'h' AND one < 6
    UNION ALL SELECT 'spam', pattern, FALSE, DATE '2024-01-01' + day + 120, NULL FROM n WHERE kind = 'h' AND one < 6 AND four < 12 AND five < 4
    UNION ALL SELECT 'trusted', pattern, TRUE, DATE '2024-01-01' + day, NULL FROM n WHERE kind = 'd' AND one < 3
    UNION ALL SELECT 'sections', pattern, FALSE, DATE '2024-01-01' + day, NULL FROM n WHERE kind = 's' AND one < 4
), u AS (
    SELECT DISTINCT url, fetched, host, steps FROM p WHERE url IS NOT NULL AND host IS NOT NULL
), a AS (
    SELECT DISTINCT url, fetched, unnest(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.')),
        list_transform(range(1, len(steps) + 1), lambda k: host || '/' || array_to_string(steps[1:k], '/')))) AS asked
    FROM u
), m AS (
    SELECT a.url, a.fetched, i.*, row_number() OVER (PARTITION BY a.url, a.fetched ORDER BY length(i.pattern) DESC, i.allows DESC, i.list DESC, i.pattern DESC) AS place,
           count(*) OVER (PARTITION BY a.url, a.fetched) AS n_active
    FROM a JOIN i ON a.asked = i.pattern AND a.fetched >= i.valid_from AND (i.valid_until IS NULL OR a.fetched < i.valid_until)
)
SELECT p.page_id, p.fetched, p.host, CAST(coalesce(m.n_active, 0) AS BIGINT) AS n_active, coalesce(NOT m.allows, FALSE) AS blocked, m.list, m.pattern
FROM p LEFT JOIN m ON p.url = m.url AND p.fetched = m.fetched AND m.place = 1
"""
