"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed n-grams of all labelled texts, per language and bucket, and combines
them by a shuffle; the matrix of log probabilities has a row for each language and a fixed number
of buckets, so its size is checked before it is broadcast. Scoring is numpy over a batch: the hashed
n-grams of all its texts become one sparse list of (text, bucket, count), multiplied with the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import table

UNKNOWN = "und"
# A matrix beyond this is refused rather than broadcast.
MOST_MATRIX_BYTES = 64 << 20
# Characters of text that are hashed at a time, and texts whose n-grams are counted at a time.
CHARACTERS_AT_A_TIME = 1 << 20
ROWS_AT_A_TIME = 64
LETTER = regex.compile(r"\p{L}")
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Grams:
    """Orders of the n-grams, in characters, and the number of buckets they are hashed to."""

    longest: int = 3
    buckets: int = 1 << 14

    def __post_init__(self):
        if self.buckets & (self.buckets - 1) or not 1 <= self.longest <= 4:
            raise ValueError("buckets must be a power of two, n-grams one to four characters long")

    def pieces(self, texts: list[str]) -> Iterator[tuple[int, str, int]]:
        """(row, piece, starts): lower-cased texts, spaces of any kind as one, in pieces of bounded length.

        An n-gram belongs to the piece in whose first `starts` characters it begins.
        """
        for row, text in enumerate(texts):
            text = " " + " ".join(text.lower().split()) + " "
            for at in range(0, len(text), CHARACTERS_AT_A_TIME):
                piece = text[at : at + CHARACTERS_AT_A_TIME + self.longest - 1]
                yield row, piece, min(len(text) - at, CHARACTERS_AT_A_TIME)

    def hashed(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, bucket) of all n-grams of the texts, some pieces at a time."""
        held, size = [], 0
        for piece in self.pieces(texts):
            held.append(piece)
            size += len(piece[1])
            if size >= CHARACTERS_AT_A_TIME:
                yield from self.hashed_pieces(held)
                held, size = [], 0
        if held:
            yield from self.hashed_pieces(held)

    def hashed_pieces(self, held: list[tuple[int, str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The n-grams of each order, of all pieces side by side; none reaches over the end of its piece."""
        row = np.repeat([r for r, _, _ in held], [len(p) for _, p, _ in held])
        codes = np.frombuffer("".join(p for _, p, _ in held).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        ends = np.cumsum([len(p) for _, p, _ in held])
        begins = ends - [len(p) for _, p, _ in held]
        left = np.repeat(ends, ends - begins) - np.arange(len(codes))
        begun = np.arange(len(codes)) - np.repeat(begins, ends - begins) < np.repeat([n for _, _, n in held], ends - begins)
        shift = np.uint64(64 - int(self.buckets).bit_length() + 1)
        mixed = np.zeros(len(codes), np.uint64)
        for n in range(1, min(self.longest, len(codes)) + 1):
            mixed = (mixed[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint64(MULTIPLIERS[(n - 1) % 3])
            mixed ^= mixed >> np.uint64(29)
            own = np.flatnonzero(begun[: len(mixed)] & (left[: len(mixed)] >= n))
            yield row[own], ((mixed[own] * np.uint64(MULTIPLIERS[0])) >> shift).astype(np.int64)

    def sparse(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, buckets and counts of the texts' n-grams, by row; those of one order and some pieces at a time."""
        for row, bucket in self.hashed(texts):
            # Pieces are in order of their rows, so the rows of a stretch are a range.
            edges = np.flatnonzero(np.append(True, row[1:] // ROWS_AT_A_TIME != row[:-1] // ROWS_AT_A_TIME))
            for a, b in zip(edges, np.append(edges[1:], len(row))):
                if a == b:
                    continue
                first = row[a]
                counts = np.bincount((row[a:b] - first) * self.buckets + bucket[a:b])
                cell = np.flatnonzero(counts)
                yield cell // self.buckets + first, cell % self.buckets, counts[cell]

    def counts(self, text: str) -> np.ndarray:
        total = np.zeros(self.buckets, np.int64)
        for _, bucket, n in self.sparse([text]):
            total[bucket] += n
        return total


@dataclass(frozen=True)
class Model:
    """Languages in order, and for each the log probability of each bucket."""

    languages: list[str]
    matrix: np.ndarray
    grams: Grams

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its posterior probability, languages equally likely.

        Ties go to the language first by code point. Without letters, or without any learned
        language: `und`, with score 0.
        """
        known = [row for row, text in enumerate(texts) if text and self.languages and LETTER.search(text)]
        scores = np.zeros((len(known), len(self.languages)))
        by_bucket = np.ascontiguousarray(self.matrix.T)
        for row, bucket, n in self.grams.sparse([texts[row] for row in known]):
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            scores[row[first]] += np.add.reduceat(by_bucket[bucket] * n[:, None], first, axis=0)
        found, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            best = scores.argmax(axis=1)
            chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            for row, place, p in zip(known, best.tolist(), chance.tolist()):
                found[row], sure[row] = self.languages[place], p
        return found, sure


def fit(docs: DataFrame, grams: Grams = Grams(), smoothing: float = 0.5) -> Model:
    """Learn from every row of `docs` (text, lang) with a lang and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                total = totals.setdefault(lang, np.zeros(grams.buckets, np.int64))
                for _, bucket in grams.hashed([t for t, own in zip(texts, langs) if own == lang]):
                    total += np.bincount(bucket, minlength=grams.buckets)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([total], pa.list_(pa.int64()))], names=["lang", "counts"]
            )

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of each language in this partition, which has all parts of it, one after the other."""
        current, total = None, None
        for batch in parts:
            for lang, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang != current:
                    if total is not None:
                        yield row(current, total)
                    current, total = lang, np.zeros(grams.buckets, np.int64)
                total += counts.values.to_numpy()
        if total is not None:
            yield row(current, total)

    def row(lang: str, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])

    labelled = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = (
        labelled.mapInArrow(count, "lang string, counts array<long>")
        .repartition("lang").sortWithinPartitions("lang").mapInArrow(add, "lang string, counts binary")
    )
    # First the languages alone, whose number decides whether the matrix may be gathered.
    most = MOST_MATRIX_BYTES // (8 * grams.buckets)
    kinds = [row.lang for row in labelled.select("lang").distinct().limit(most + 1).collect()]
    if len(kinds) > most:
        raise ValueError(f"more than {most} languages: use fewer buckets")
    # One packed row for each language.
    found = {r["lang"]: np.frombuffer(bytes(r["counts"]), np.int64) for r in counts.collect()}
    languages = sorted(found)
    dense = np.array([found[lang] for lang in languages]).reshape(len(languages), grams.buckets) + smoothing
    return Model(languages, np.log(dense) - np.log(dense.sum(axis=1, keepdims=True)), grams)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of `docs` (doc_id, text, held_out)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def fold(folds: int, number: int) -> Column:
    """Whether the document is of that fold; one without an id counts as having an empty id."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == number


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold(3, 1).alias("held_out"))
    return predict(docs, fit(docs.filter("NOT held_out")))
