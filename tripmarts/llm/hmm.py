"""A hidden Markov language model: Baum-Welch over the whole corpus, exact likelihoods.

Words fall into a fixed number of hashed classes. States emit classes, and a class emits its words by
their smoothed counts, so the parameters that travel are bounded while word counts, as large as
the vocabulary, stay distributed. Texts are stored once as chunks: packed word numbers with the
chunk's own vocabulary. Vocabularies, not texts, meet the counts in a join and come back as arrays.

Each round of Baum-Welch broadcasts the parameters, sums expected counts within tasks and then
across them. Training and scores both run the scaled recursions over whole texts: many side by side,
laid out step by step. For texts too long to keep every step, the forward chances at the
edges of blocks are kept, and each block is run again on the way back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import stored, table
from tripmarts.llm.langid import fold

# Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 16 << 20
# Text split into words at a time.
SPLIT_BYTES = 4 << 20
# Words of the sequences that run side by side, and of the steps kept for the backward pass.
WORDS_AT_A_TIME = 1 << 19


@dataclass(frozen=True)
class Shape:
    states: int = 12
    classes: int = 4096
    rounds: int = 3
    # Chance to stay in a state, and spread of the log emissions, before the first round.
    stay: float = 0.999
    spread: float = 0.5
    # Expected counts are smoothed by so many observations, shared as the classes are overall.
    smoothing: float = 20.0
    seed: int = 11


@dataclass
class Parameters:
    """Start and transition chances, and the chance of each class (the last is the end) by state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


# --- chunks -------------------------------------------------------------------------------------


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte by byte of their significance."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes | None) -> np.ndarray:
    """The numbers; none for null, as of a chunk whose texts have no words."""
    if data is None:
        return np.empty(0, np.uint32)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, words binary, "
    "vocabulary array<binary>, counts array<long>"
)


def words_of_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, lower-cased in A-Z, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets, flat = lists.offsets.to_numpy(), lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    upto = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    return flat.filter(real), np.diff(upto[offsets - offsets[0]])


def parts_of(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Parts of the batch with at most so many bytes in the column, but for longer values alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    at, done = 0, 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at), int(ends[to - 1] - done)
        at, done = to, int(ends[to - 1])


def make_chunks(docs: DataFrame) -> DataFrame:
    """From (doc_id, text, held_out): texts as numbers of the words of each chunk, with counts in training texts.

    Longer texts come first within a partition, so that those of like length run side by side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part, bytes_of_text in parts_of(batch, 1, SPLIT_BYTES):
                parts.append((part.column(0), part.column(2), *words_of_texts(part.column(1))))
                size += bytes_of_text
                if size >= CHUNK_BYTES:
                    yield flush(number, parts)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield flush(number, parts)

    def flush(number: int, parts: list) -> pa.RecordBatch:
        ids, held, words, sizes = zip(*parts)
        coded = pa.concat_arrays(words).dictionary_encode()
        numbers, seen = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
        held, sizes = pa.concat_arrays(held), np.concatenate(sizes)
        training = np.repeat(~held.to_numpy(zero_copy_only=False), sizes)
        counts = np.bincount(numbers[training], minlength=len(seen))

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = {
            "chunk": pa.array([number], pa.int64()), "doc_ids": one(pa.concat_arrays(ids)), "held": one(held),
            "sizes": one(pa.array(sizes, pa.int32())), "words": pa.array([pack(numbers)], pa.binary()),
            "vocabulary": one(seen), "counts": one(pa.array(counts, pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), "held_out")
    return slim.sortWithinPartitions(F.octet_length("text").desc()).mapInArrow(run, CHUNK)


def vocabulary(chunks: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """(chunk, place, word) of all chunks, and each word once with its count in training texts and its class."""
    items = chunks.select("chunk", F.posexplode(F.arrays_zip("vocabulary", "counts")).alias("place", "item"))
    rows = items.select("chunk", "place", F.col("item.vocabulary").alias("word"), F.col("item.counts").alias("n"))
    kinds = stored(rows.groupBy("word").agg(F.sum("n").alias("c")))
    return rows.select("chunk", "place", "word"), kinds


def class_of(shape: Shape):
    return F.pmod(F.xxhash64("word"), shape.classes).cast("int")


def chunk_counts(rows: DataFrame, kinds: DataFrame, shape: Shape) -> DataFrame:
    """(chunk, c, cls): for the vocabulary of each chunk, in its order, packed counts and classes."""
    known = kinds.select("word", "c", class_of(shape).alias("cls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            chunk, c, cls = (column.to_numpy() for column in batch.columns)
            cuts = np.flatnonzero(chunk[1:] != chunk[:-1]) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(chunk))):
                if a == b:
                    continue
                if held and chunk[a] != current:
                    yield flush(current, held)
                    held = []
                current = chunk[a]
                held.append((c[a:b], cls[a:b]))
        if held:
            yield flush(current, held)

    def flush(chunk, held) -> pa.RecordBatch:
        c, cls = (np.concatenate(side) for side in zip(*held))
        if len(c) and c.max() >= 1 << 32:
            low, high = c & 0xFFFFFFFF, c >> 32
        else:
            low, high = c, np.empty(0, np.int64)
        columns = [pa.array([chunk], pa.int64()), *(pa.array([pack(x)], pa.binary()) for x in (low, high, cls))]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "low", "high", "cls"])

    return (
        rows.join(known, "word").select("chunk", "place", "c", "cls")
        .repartition("chunk").sortWithinPartitions("chunk", "place")
        .select("chunk", "c", "cls").mapInArrow(run, "chunk long, low binary, high binary, cls binary")
    )


# --- recursions ---------------------------------------------------------------------------------


class Sequences:
    """Sequences of classes that run side by side, longest first, laid out step by step."""

    def __init__(self, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[self.order], sizes[self.order]
        self.steps = int(sizes[0]) if len(sizes) else 0
        # Sequences that have a step, and where its places begin.
        self.active = np.searchsorted(-sizes, -np.arange(self.steps + 1), "left")
        self.begins = np.append(0, np.cumsum(self.active[:-1]))
        step = np.repeat(np.arange(self.steps), self.active[:-1])
        self.which = np.arange(len(step)) - self.begins[step]
        self.classes = classes[starts[self.which] + step]

    def blocks(self, most: int) -> list[tuple[int, int]]:
        """Ranges of steps with at most so many places, but for wider steps alone."""
        out, step = [], 0
        while step < self.steps:
            upto = int(np.searchsorted(self.begins, self.begins[step] + most, "right")) - 1
            out.append((step, max(step + 1, upto)))
            step = out[-1][1]
        return out


def onward(seqs: Sequences, p: Parameters, first: int, last: int, chance, chances=None) -> tuple[np.ndarray, np.ndarray]:
    """The scales of the steps from `first` to before `last`, and the scaled chances after them.

    `chance` holds the scaled chances before, none at the start; `chances` gets those of every place.
    """
    begin, ones = seqs.begins[first], np.ones(len(p.start))
    scales = np.empty(seqs.begins[last] - begin)
    for step in range(first, last):
        a, b = seqs.begins[step] - begin, seqs.begins[step + 1] - begin
        here = np.empty((b - a, len(p.start))) if chances is None else chances[a:b]
        np.take(p.emit, seqs.classes[a + begin : b + begin], axis=0, out=here, mode="clip")
        here *= p.start if chance is None else chance[: b - a] @ p.move
        scale = scales[a:b]
        np.matmul(here, ones, out=scale)
        here /= scale[:, None]
        chance = here
    return scales, chance


def forward(seqs: Sequences, p: Parameters) -> np.ndarray:
    """Natural log likelihood of each sequence, in the given order."""
    scales, _ = onward(seqs, p, 0, seqs.steps, None)
    logs = np.bincount(seqs.which, np.log(scales), minlength=len(seqs.order))
    out = np.empty(len(logs))
    out[seqs.order] = logs
    return out


@dataclass
class Expected:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, shape: Shape) -> Expected:
        s = shape.states
        return cls(np.zeros(s), np.zeros((s, s)), np.zeros((shape.classes + 1, s)))

    def add(self, seqs: Sequences, p: Parameters, at_once: int = WORDS_AT_A_TIME) -> None:
        """Baum-Welch: expected starts, moves and emissions of these sequences."""
        blocks = seqs.blocks(at_once)
        entries = [None]
        for first, last in blocks[:-1]:
            entries.append(onward(seqs, p, first, last, entries[-1])[1].copy())
        moves, seen, back_move = np.zeros_like(self.move), None, np.ascontiguousarray(p.move.T)
        for (first, last), entry in zip(reversed(blocks), reversed(entries)):
            begin, end = seqs.begins[first], seqs.begins[last]
            chances = np.empty((end - begin, len(p.start)))
            scales, _ = onward(seqs, p, first, last, entry, chances)
            for step in range(last - 1, first - 1, -1):
                a, b = seqs.begins[step] - begin, seqs.begins[step + 1] - begin
                here, then = chances[a:b], seqs.active[step + 1]
                back = np.ones((b - a, len(p.start)))
                if then:
                    np.matmul(seen, back_move, out=back[:then])
                    moves += here[:then].T @ seen
                seen = p.emit[seqs.classes[a + begin : b + begin]]
                seen *= back
                seen /= scales[a:b, None]
                # From here on the place holds the chance given the whole sequence.
                here *= back
            if not first:
                self.start += chances[: seqs.active[0]].sum(axis=0)
            self.add_emissions(seqs.classes[begin:end], chances)
        self.move += moves * p.move

    def add_emissions(self, classes: np.ndarray, chances: np.ndarray) -> None:
        # Sixteen bits are sorted by radix.
        order = np.argsort(classes.astype(np.uint16) if len(self.emit) <= 1 << 16 else classes, kind="stable")
        found = classes[order]
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        self.emit[found[first]] += np.add.reduceat(chances[order], first, axis=0)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.start, self.move.ravel(), self.emit.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray, shape: Shape) -> Expected:
        s = shape.states
        return cls(flat[:s], flat[s : s + s * s].reshape(s, s), flat[s + s * s :].reshape(-1, s))


def spread(sizes: np.ndarray, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes with an end after each text, and where each sequence starts and how long it is."""
    longer = sizes + 1
    starts = np.cumsum(longer) - longer
    out = np.full(longer.sum(), end, np.int64)
    inside = np.ones(len(out), bool)
    inside[starts + sizes] = False
    out[inside] = classes
    return out, starts, longer


def side_by_side(classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, Sequences]]:
    """The sequences by length, in groups of about WORDS_AT_A_TIME: which they are, and laid out to run."""
    by_size = np.argsort(-sizes, kind="stable")
    totals = np.cumsum(sizes[by_size])
    at = 0
    while at < len(sizes):
        done = totals[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(totals, done + WORDS_AT_A_TIME, "right")))
        group = by_size[at:to]
        yield group, Sequences(classes, starts[group], sizes[group])
        at = to


# --- model --------------------------------------------------------------------------------------


def first_parameters(overall: np.ndarray, shape: Shape) -> Parameters:
    """Before the first round: sticky states that emit the overall classes, each with its own noise."""
    s = shape.states
    noise = np.random.default_rng(shape.seed).standard_normal((len(overall), s)) * shape.spread
    emit = overall[:, None] * np.exp(noise)
    rest = (1 - shape.stay) / max(1, s - 1)
    move = np.full((s, s), rest) + np.eye(s) * (shape.stay - rest)
    return Parameters(np.full(s, 1 / s), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def re_estimated(found: Expected, overall: np.ndarray, shape: Shape) -> Parameters:
    start = found.start + 1
    move = found.move + 1
    emit = found.emit + shape.smoothing * overall[:, None]
    return Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(coded: DataFrame, overall: np.ndarray, shape: Shape) -> Parameters:
    """Baum-Welch on the training texts of all chunks (words, cls, sizes, held)."""
    spark = coded.sparkSession
    parameters = first_parameters(overall, shape)
    columns = coded.select("sizes", "held", "words", "cls")
    for _ in range(shape.rounds):
        shared = spark.sparkContext.broadcast(parameters)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = Expected.none(shape)
            for batch in batches:
                for sizes, held, words, cls in zip(*(c.to_pylist() for c in batch.columns)):
                    sizes, held = np.array(sizes, np.int64), np.array(held, bool)
                    classes, starts, longer = spread(sizes, unpack(cls)[unpack(words)], shape.classes)
                    for _, seqs in side_by_side(classes, starts[~held], longer[~held]):
                        found.add(seqs, shared.value)
            flat = found.flat()
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["place", "amount"])

        sums = (
            columns.mapInArrow(count, "place long, amount double")
            .groupBy("place").agg(F.sum("amount").alias("amount")).toPandas()
        )
        flat = np.zeros(len(Expected.none(shape).flat()))
        flat[sums["place"].to_numpy(np.int64)] = sums["amount"].to_numpy(np.float64)
        parameters = re_estimated(Expected.of(flat, shape), overall, shape)
    return parameters


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_texts(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Scores of each row of `docs` (doc_id, text, held_out), learned from those not held out.

    A text is its words, lower-cased in A-Z, and an end, which is a token. `base_score` is by the
    unigram with one added, `score` the log10 likelihood under the model. A null text is
    empty: its end alone. A null `held_out` counts as true. Rows stay apart, repeated or not. With no
    training text nothing is known, and all is spread evenly.
    """
    docs = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(True)).alias("held_out"))
    chunks = stored(make_chunks(docs))
    rows, kinds = vocabulary(chunks, shape)
    by_class = (
        kinds.filter("c > 0").groupBy(class_of(shape).alias("cls"))
        .agg(F.sum("c").alias("words"), F.count("*").alias("kinds")).toPandas()
    )
    texts = chunks.select(F.aggregate("held", F.lit(0).cast("long"), lambda n, x: n + F.when(x, 0).otherwise(1)).alias("n"))
    ends = texts.agg(F.sum("n")).first()[0] or 0
    words, of_class = np.zeros(shape.classes), np.zeros(shape.classes)
    words[by_class["cls"].to_numpy(np.int64)] = by_class["words"].to_numpy(np.float64)
    of_class[by_class["cls"].to_numpy(np.int64)] = by_class["kinds"].to_numpy(np.float64)
    total = int(by_class["words"].sum()) + ends
    distinct = int(by_class["kinds"].sum()) + (ends > 0)
    overall = np.append(words, ends) + 0.5
    overall /= overall.sum()
    within = np.log10(words + of_class + 1)

    coded = stored(chunks.drop("vocabulary", "counts").join(chunk_counts(rows, kinds, shape), "chunk", "left"))
    shared = docs.sparkSession.sparkContext.broadcast(train(coded, overall, shape))
    base = np.log10(total + distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, held, sizes, numbers, low, high, cls in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.array(sizes, np.int64)
                c, cls, numbers = (unpack(x).astype(np.int64) for x in (low, cls, numbers))
                if len(more := unpack(high)):
                    c += more.astype(np.int64) << 32
                log_c = np.log10(c + 1.0)
                classes, starts, longer = spread(sizes, cls[numbers], shape.classes)
                likely = np.empty(len(ids))
                for part, seqs in side_by_side(classes, starts, longer):
                    likely[part] = forward(seqs, shared.value)
                edges = np.append(0, np.cumsum(sizes))

                def sums(values):
                    return np.diff(np.append(0, np.cumsum(values))[edges])

                of_words, known = sums(log_c[numbers]), sums(c[numbers] > 0)
                columns = (
                    ids, held, longer, known.astype(np.int64) + (ends > 0), np.full(len(ids), total),
                    of_words - sizes * base + np.log10((ends + 1) / (total + distinct + 1)),
                    likely / np.log(10) + of_words - sums(within[cls][numbers]),
                )
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                names = [field.split()[0] for field in SCORES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=names)

    return coded.select("doc_ids", "held", "sizes", "words", "low", "high", "cls").mapInArrow(score, SCORES)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold(7, 2).alias("held_out"))
    return score_texts(docs)
