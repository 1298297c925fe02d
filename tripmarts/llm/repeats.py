"""Repeated passages by a depth-limited radix sort of suffixes.

Two suffixes are told apart only by their first `length` bytes, so groups that are still equal
at that depth are exactly the windows that occur more than once. The passes go from the most
significant digit down, and a suffix alone in its group leaves the sort:

1. The first digit is the window's anchor: of its stretches of `gram` bytes, the one with the
   smallest hash, leftmost if equal. It depends on the window's bytes alone, so equal windows have
   equal anchors at equal places, and neighbouring windows share one: a row for an anchor and
   its range of windows stands for about 70 suffixes. Anchors that occur once leave.
2. The second digit is the hash of all bytes that the anchor's windows cover (128 bits with the first).
   Anchors that agree in it agree in all their windows, which are done.
3. What is left lies at the ends of repeated passages. One anchor of each kind in such a group
   fetches its bytes, and its windows are sorted one by one by all their bytes, eight at a time.

Groups are counted with partial sums, stored and joined back, both sides as plain exchanges, so that
adaptive execution can split an anchor shared by a third of all documents. A group of very many kinds is
dealt out by single windows, which meet by two 64-bit hashes. Texts are told apart by their id and 64 bits of a hash, so one id may stand on many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.llm.common import discard, stored, table

# Windows of a text hashed at a time; the place within this stretch fits the low bits of a key.
STRETCH = 1 << 18
PLACE_BITS = 20
# Kinds of a group that a task compares; larger groups are dealt out by window.
CROWD = 4096
# Bytes of fetched contexts whose windows are sorted at a time.
CONTEXT_BYTES = 4 << 20
CONTEXTS_AT_A_TIME = 4096
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Depth:
    length: int = 200
    gram: int = 64

    def __post_init__(self):
        if not 1 <= self.gram <= self.length or self.length - self.gram > 255:
            raise ValueError("the anchor must be shorter than the window, by 255 bytes at most")


@lru_cache(maxsize=8)
def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        both.append(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, factor, np.uint64)])))
    return both[0], both[1]


@lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def rolling(raw: np.ndarray, width: int, base: int, starts: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each start (by default, from all that have so many)."""
    up, down = powers(base, max(2 * STRETCH, 1 << len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(byte_codes()[raw] * up[: len(raw)], out=sums[1:])
    if starts is None:
        count = max(0, len(raw) - width + 1)
        mixed = (sums[width:] - sums[:count]) * down[:count]
    else:
        mixed = (sums[starts + width] - sums[starts]) * down[starts]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def anchors(data: bytes, depth: Depth) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each stretch: hash of the anchor, of all it covers, its place, and the range of its windows.

    The windows of an anchor at place p start at p - far to p - near.
    """
    width = depth.length - depth.gram + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, len(data) - depth.length + 1, STRETCH):
        raw = np.frombuffer(data[at : at + STRETCH + depth.length - 1], np.uint8)
        grams = rolling(raw, depth.gram, BASES[0])
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        windows = len(grams) - width + 1
        # The least key of each window: of two halves, each running within blocks of one window.
        blocks = np.concatenate([keys, np.full(-len(keys) % width, ~np.uint64(0))]).reshape(-1, width)
        onward = np.minimum.accumulate(blocks, axis=1).ravel()
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(backward[:windows], onward[width - 1 : width - 1 + windows])
        place = (least & low).astype(np.int64)
        cuts = np.flatnonzero(np.diff(place)) + 1
        first, last = np.append(0, cuts), np.append(cuts - 1, windows - 1)
        own = place[first]
        covered = [
            xxhash.xxh3_64_intdigest(data[at + a : at + b + depth.length])
            for a, b in zip(first.tolist(), last.tolist())
        ]
        yield grams[own], np.array(covered, np.uint64), own + at, own - last, own - first


def packed(place: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Place and range of windows in one number."""
    return (place << 16) | (far << 8) | near


PLACE, FAR, NEAR = (lambda at: at >> 16), (lambda at: (at >> 8) & 255), (lambda at: at & 255)


def shape_of(at: Column) -> Column:
    """The range of windows about an anchor: kinds of different ranges are different."""
    return at.bitwiseAND(F.lit(0xFFFF))


def row_key(doc_id: int | None, data: bytes) -> tuple[int, int]:
    """What tells texts apart: the id, none as 0, and 64 bits of a hash of the id's being there and the text."""
    return doc_id or 0, xxhash.xxh3_64_intdigest(data, seed=doc_id is None) - (1 << 63)


def find_anchors(docs: DataFrame, depth: Depth) -> DataFrame:
    """(g, c, row, mark, at) for each anchor of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode()
                row, mark = row_key(doc_id, data)
                for g, c, place, near, far in anchors(data, depth):
                    keys = np.full(len(g), row, np.int64), np.full(len(g), mark, np.int64)
                    out.append((g.view(np.int64), c.view(np.int64), *keys, packed(place, near, far)))
                    held += len(g)
                if held > STRETCH:
                    yield flush(out)
                    out, held = [], 0
            if out:
                yield flush(out)

    def flush(parts: list) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(side)) for side in zip(*parts)]
        return pa.RecordBatch.from_arrays(columns, names=["g", "c", "row", "mark", "at"])

    schema = "g long, c long, row long, mark long, at long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with their key and, for cheap shuffles, their compressed bytes.

    All columns but the text are carried as one struct.
    """
    rest = [c for c in docs.columns if c != "text"]
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"),
    )
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("mark", T.LongType()),
        T.StructField("bytes", T.BinaryType()), T.StructField("rest", slim.schema["rest"].dataType),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(1)]
            keys = [row_key(i, data) for i, data in zip(batch.column(0).to_pylist(), texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array(list(map(press, texts)), pa.binary()), batch.column(2)],
                names=["row", "mark", "bytes", "rest"],
            )

    return slim.mapInArrow(run, schema)


def unpressed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def fetch_contexts(docs: DataFrame, wanted: DataFrame, depth: Depth) -> DataFrame:
    """(g, crowd, single, row, mark, at, context): the bytes that the windows of the wanted anchors cover."""
    asked = wanted.groupBy("row", "mark").agg(
        F.collect_list(F.struct("g", "crowd", "single", "at")).alias("asked")
    )
    # Texts that occur twice under one id have one key; fetching either is the same.
    texts = keyed(docs.select("doc_id", "text")).select("row", "mark", "bytes")

    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["g", "crowd", "single", "row", "mark", "at", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for row, mark, pressed, items in zip(*batch.columns):
                row, mark, data = row.as_py(), mark.as_py(), unpressed(pressed.as_py())
                for item in items.as_py():
                    at = item["at"]
                    context = data[PLACE(at) - FAR(at) : PLACE(at) - NEAR(at) + depth.length]
                    out.append((item["g"], item["crowd"], item["single"], row, mark, at, context))
                if len(out) >= CONTEXTS_AT_A_TIME:
                    yield flush(out)
                    out = []
        if out:
            yield flush(out)

    def flush(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*out), kinds)], names=names)

    return texts.join(asked, ["row", "mark"]).select("row", "mark", "bytes", "asked").mapInArrow(
        run, "g long, crowd long, single boolean, row long, mark long, at long, context binary"
    )


def windows_of(contexts: list[bytes], depth: Depth) -> tuple[np.ndarray, ...]:
    """Sizes of the contexts and numbers of their windows; of each window, its context and place in it."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    counts = sizes - depth.length + 1
    which = np.repeat(np.arange(len(contexts)), counts)
    return sizes, counts, which, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def in_equal_groups(raw: bytes, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows equal another of their group in all `length` bytes; groups are side by side.

    Passes of eight bytes, the most significant first. A pass sorts only the groups that it tells apart,
    and windows that are alone leave.
    """
    digit = min(8, length)
    numbers = np.ndarray(max(0, len(raw) - 7), ">u8", raw, strides=(1,)) if digit == 8 else None
    alive = np.arange(len(starts))
    for offset in [*range(0, length - digit + 1, digit), *([length - digit] if length % digit else [])]:
        if not len(alive):
            break
        places = starts[alive] + offset
        if numbers is not None:
            key = numbers[places].astype(np.uint64)
        else:
            key = np.array([int.from_bytes(raw[p : p + digit], "big") for p in places.tolist()], np.uint64)
        of = group[alive]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(of))))
        uneven = np.logical_or.reduceat(key != key[first][number], first)[number]
        mixed = np.flatnonzero(uneven)
        order = np.lexsort((key[mixed], number[mixed]))
        alive[mixed], key[mixed] = alive[mixed][order], key[mixed][order]
        new = np.append(True, (number[1:] != number[:-1]) | (key[1:] != key[:-1]))
        group[alive] = np.cumsum(new)
        alive = alive[~(new & np.append(new[1:], True))]
    return alive


def window_hashes(ats: np.ndarray, contexts: list[bytes], depth: Depth) -> tuple[np.ndarray, ...]:
    """Of all windows of these contexts: which context, the start in the text, and two hashes."""
    sizes, counts, which, inside = windows_of(contexts, depth)
    hashes: tuple[list, list] = ([], [])
    step = max(1, STRETCH // (2 * depth.length))
    for at in range(0, len(contexts), step):
        raw = np.frombuffer(b"".join(contexts[at : at + step]), np.uint8)
        size, count = sizes[at : at + step], counts[at : at + step]
        done = count.cumsum() - count
        own = np.arange(count.sum()) - np.repeat(done, count) + np.repeat(size.cumsum() - size, count)
        for base, found in zip(BASES, hashes):
            found.append(rolling(raw, depth.length, base, own))
    one, two = (np.concatenate(found) for found in hashes)
    return which, (PLACE(ats) - FAR(ats))[which] + inside, one, two


def spans_of_starts(rows, marks, starts: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans covered by windows, those that start side by side joined; sorted by row, then start."""
    order = np.lexsort((starts, marks, rows))
    rows, marks, starts = rows[order], marks[order], starts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (marks[1:] != marks[:-1]) | (starts[1:] > starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1 if len(first) else first
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[first]), pa.array(marks[first]), pa.array(starts[first]), pa.array(starts[last] + length)],
        names=["row", "mark", "start", "stop"],
    )


SPANS = "row long, mark long, start long, stop long"


def sort_windows(contexts: DataFrame, depth: Depth) -> DataFrame:
    """Spans of the single anchors' windows that occur elsewhere in the same group.

    Equal windows are in one group, and a group is in one partition: groups stream by, a few at a time.
    """

    def flush(held: list[tuple]) -> pa.RecordBatch:
        singles, rows, marks, ats = (np.concatenate(side) for side in list(zip(*held))[1:5])
        texts = [text for part in held for text in part[5]]
        sizes, _, which, inside = windows_of(texts, depth)
        # A group may come in several parts, one after the other.
        number = np.cumsum([at > 0 and part[0] != held[at - 1][0] for at, part in enumerate(held)])
        group = np.repeat(number, [len(part[5]) for part in held])
        twice = in_equal_groups(b"".join(texts), (sizes.cumsum() - sizes)[which] + inside, group[which], depth.length)
        chosen = twice[singles[which[twice]]]
        own = which[chosen]
        return spans_of_starts(rows[own], marks[own], (PLACE(ats) - FAR(ats))[own] + inside[chosen], depth.length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            g, single, row, mark, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:5])
            texts = batch.column(5).to_pylist()
            for a, b in group_slices(g):
                if size > CONTEXT_BYTES and held and held[-1][0] != g[a]:
                    yield flush(held)
                    held, size = [], 0
                held.append((g[a], single[a:b], row[a:b], mark[a:b], at[a:b], texts[a:b]))
                size += sum(map(len, texts[a:b]))
        if held:
            yield flush(held)

    return (
        contexts.repartition("g").sortWithinPartitions("g")
        .select("g", "single", "row", "mark", "at", "context").mapInArrow(run, SPANS)
    )


def group_slices(g: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(g[1:] != g[:-1]) + 1
    return zip(np.append(0, cuts).tolist(), np.append(cuts, len(g)).tolist()) if len(g) else iter(())


def deal_windows(contexts: DataFrame, depth: Depth) -> DataFrame:
    """As `sort_windows`, with a row for each window: for groups too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single, row, mark, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:4])
            for part in range(0, batch.num_rows, 512):
                cut = slice(part, part + 512)
                which, starts, one, two = window_hashes(at[cut], batch.column(4)[cut].to_pylist(), depth)
                columns = (row[cut][which], mark[cut][which], starts, single[cut][which], one.view(np.int64), two.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["row", "mark", "start", "single", "one", "two"]
                )

    windows = contexts.select("single", "row", "mark", "at", "context").mapInArrow(
        run, "row long, mark long, start long, single boolean, one long, two long"
    )
    counted = windows.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1")
    return windows.filter("single").join(counted, ["one", "two"]).select(
        "row", "mark", "start", (F.col("start") + depth.length).alias("stop")
    )


def repeated_spans(docs: DataFrame, depth: Depth = Depth(), crowd: int = CROWD) -> DataFrame:
    """(row, mark, spans): for each text with any, the spans covered by windows that occur elsewhere too."""
    found = stored(find_anchors(docs, depth))
    # Stored, so that both sides of the join are plain exchanges, which can be split where one anchor is frequent.
    twice = stored(found.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g"))
    alive = stored(found.join(twice, "g"))
    discard(found)
    discard(twice)
    kind = ["g", "c", "shape"]
    alive = alive.withColumn("shape", shape_of(F.col("at")))
    kinds = stored(alive.groupBy(*kind).agg(F.count("*").alias("n"), F.min(F.struct("row", "mark", "at")).alias("one")))
    groups = kinds.groupBy("g").agg(F.count("*").alias("crowd"), F.min("n").alias("fewest"))
    wanted = kinds.join(groups.filter("crowd > 1 AND fewest = 1"), "g").select(
        "g", "crowd", (F.col("n") == 1).alias("single"), "one.row", "one.mark", "one.at"
    )
    contexts = stored(fetch_contexts(docs, wanted, depth))
    place = F.shiftright("at", 16)
    far = F.shiftright("at", 8).bitwiseAND(F.lit(255))
    near = F.col("at").bitwiseAND(F.lit(255))
    whole = alive.join(kinds.filter("n > 1").select(*kind), kind).select(
        "row", "mark", (place - far).alias("start"), (place - near + depth.length).alias("stop")
    )
    parts = sort_windows(contexts.filter(F.col("crowd") <= crowd), depth).union(
        deal_windows(contexts.filter(F.col("crowd") > crowd), depth)
    )
    return whole.union(parts).groupBy("row", "mark").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans, in order; spans that touch are one run."""
    out: list[list[int]] = []
    for span in sorted((s["start"], s["stop"]) for s in spans):
        if out and span[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span[1])
        else:
            out.append(list(span))
    return [tuple(run) for run in out]


def without_repeats(
    docs: DataFrame, depth: Depth = Depth(), crowd: int = CROWD, as_text: bool = False
) -> DataFrame:
    """The columns of `docs` but the text as struct `rest`, with kept, n_bytes, n_removed, n_spans.

    `kept` holds the bytes that no window of `depth.length` bytes covers that starts anywhere else
    as well, in the same text or another; all occurrences go. A null text is empty. Repeated rows repeat each
    other's text, so they lose all of it, if it is long enough. With `as_text`, `kept` is a
    string, and a character that lost some of its bytes is gone as a whole.
    """
    spans = repeated_spans(docs, depth, crowd)
    texts = keyed(docs)
    joined = texts.join(spans, ["row", "mark"], "left").select("rest", "bytes", "spans")
    schema = T.StructType([
        joined.schema["rest"], T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pressed, found in zip(batch.column(1), batch.column(2)):
                data = unpressed(pressed.as_py())
                runs = merged(found.as_py() or [])
                edges = [0, *(edge for one in runs for edge in one), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((
                    kept.decode("utf-8", "ignore") if as_text else kept, len(data), len(data) - len(kept), len(runs)
                ))
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["rest", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return joined.mapInArrow(run, schema)


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "rest.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
