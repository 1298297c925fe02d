"""Byte-level BPE: merges replayed over a whole slice of the corpus at once, and decoding.

A slice is an Arrow batch. Its distinct new words are laid out as one sequence of tokens. An
inverted index maps the rank of a merge to the positions at which it applies; merges are taken
in rank order, each applied to all its positions, and only the neighbours of a merged token enter
new positions into the index. Words never touch, so the result does not depend on the slices, and no
rows are shuffled. Words seen before in the same Python worker are remembered, up to a fixed number.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
# Words, and ids of words, that a worker remembers; beyond either it starts anew.
WORDS_REMEMBERED = 300_000
IDS_REMEMBERED = 4_000_000
# Characters of text whose new words are merged at a time.
SLICE = 4 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The merges of a vocabulary: pairs of ids that give a token, whose id is the rank of the merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = size = max(ranks.values()) + 2
        codes, found = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    codes.append(left * size + right)
                    found.append(rank)
        order = np.argsort(codes)
        self.codes, self.found = np.array(codes, np.int64)[order], np.array(found, np.int32)[order]
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.of_bytes = self.of(self.bytes[:, None].astype(np.int64), self.bytes)
        # Merging to such a token may make a pair of no higher rank possible.
        self.careful = np.zeros(size, bool)
        for side in np.divmod(self.codes, size):
            self.careful[side[self.found <= side]] = True

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        codes = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.found[at], np.int32(-1))


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in one array, and how many each has.

    `index` has, for each rank, the positions where its pair may stand. Ranks are taken in order and
    applied to all their positions; the pairs that a merge makes with its neighbours are looked up
    and enter the index, and a lower rank among them is next. Of pairs that overlap, every second one
    is merged. Where a rank stands twice in a word and its merges could make a lower rank possible, they are
    done one by one from the left, and the rest of such a word waits until that rank is merged: the only
    part that takes a step for each place, not for all. Between words stands a token that no merge has.
    """
    gap = merges.size - 1
    raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
    gaps = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    ids = merges.bytes[raw]
    ids[gaps] = gap
    rank_at = np.append(merges.of_bytes[raw[:-1], raw[1:]], np.int32(-1))
    rank_at[gaps] = -1
    rank_at[gaps[1:] - 1] = -1
    after = np.arange(1, len(raw) + 1, dtype=np.int32)
    before = np.arange(-1, len(raw) - 1, dtype=np.int32)
    owner = np.repeat(np.arange(len(gaps), dtype=np.int32), np.diff(gaps, append=len(raw)))

    index: list[list[np.ndarray]] = [[] for _ in range(merges.size)]

    def enter(places: np.ndarray, ranks: np.ndarray) -> None:
        real = ranks >= 0
        places, ranks = places[real], ranks[real]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        edges = [0, *cuts.tolist(), len(ranks)] if len(ranks) else [0]
        for a, b, rank in zip(edges, edges[1:], ranks[edges[:-1]].tolist()):
            index[rank].append(places[a:b])

    def merge(places: np.ndarray, rank: int) -> np.ndarray:
        """Merge these pairs, which do not overlap; the ranks that became possible."""
        then = after[places]
        beyond = after[then]
        ids[places], ids[then], rank_at[then] = rank, -1, -1
        after[places], before[beyond] = beyond, places
        earlier = before[places]
        right = merges.of(np.int64(rank), ids[beyond])
        left = merges.of(ids[earlier].astype(np.int64), np.int64(rank))
        rank_at[places], rank_at[earlier] = right, left
        new = np.concatenate([right, left])
        enter(np.concatenate([places, earlier]), new)
        return new

    def merge_singly(places: np.ndarray, rank: int) -> list[np.ndarray]:
        """Merge from the left in each word; the ranks that became possible."""
        waiting, made = set(), [np.empty(0, np.int32)]
        for at, word in zip(places, owner[places].tolist()):
            if rank_at[at] != rank:
                continue
            if word in waiting:
                index[rank].append(np.array([at], np.int32))
                continue
            made.append(merge(np.array([at], np.int32), rank))
            if ((made[-1] >= 0) & (made[-1] <= rank)).any():
                waiting.add(word)
        return made

    start = np.flatnonzero(rank_at >= 0).astype(np.int32)
    enter(start, rank_at[start])
    rank = 0
    while rank < merges.size:
        found, index[rank] = index[rank], []
        if not found:
            rank += 1
            continue
        places = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        places = places[rank_at[places] == rank]
        made = []
        if len(places) > 1:
            # Words in which the rank stands more than once may need care.
            words_of = owner[places]
            again = np.zeros(len(places), bool)
            again[1:] = words_of[1:] == words_of[:-1]
            if again.any() and not merges.careful[rank]:
                # Pairs of one token with itself overlap in a run; from its left, every second one is merged.
                first = np.append(True, after[places[:-1]] != places[1:])
                number = np.arange(len(places))
                places = places[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]
            elif again.any():
                again[:-1] |= again[1:]
                made += merge_singly(places[again], rank)
                places = places[~again]
        if len(places):
            made.append(merge(places, rank))
        new = np.concatenate(made) if made else np.empty(0, np.int32)
        below = new[(new >= 0) & (new <= rank)]
        rank = int(below.min()) if len(below) else rank if index[rank] else rank + 1
    alive = (ids >= 0) & (ids != gap)
    counts = np.cumsum(alive)[gaps]
    return ids[alive].astype("<u4"), np.diff(counts)


class Numbering(dict):
    """Words in order of first sight; `new` has those seen since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `values` that start and are as long as told, one after the other."""
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
    return values[places]


class Codec:
    """Encoder and decoder of one vocabulary, kept by a Python worker between tasks."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.merges = Merges(ranks)
        self.find = regex.compile(pattern).findall
        tokens = [b""] * self.merges.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = np.array(tokens, object)
        self.forget()

    def forget(self) -> None:
        self.known = Numbering()
        self.ids = np.empty(0, "<u4")
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if len(self.known) > WORDS_REMEMBERED or len(self.ids) > IDS_REMEMBERED:
            self.forget()
        number = self.known.__getitem__
        split = []
        for text in texts:
            words = self.find(text)
            split.append(np.fromiter(map(number, words), np.int32, len(words)))
        if self.known.new:
            ids, sizes = replay([w.encode() for w in self.known.new], self.merges)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
            self.known.new = []
        return [ragged(self.ids, self.starts[words], self.sizes[words]).tobytes() for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in order, null ones empty, in lists of about SLICE characters or of one longer text."""
    held, size = [], 0
    for item in texts:
        text = item.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids) for each row of `docs` (doc_id, text): the ids as packed 32-bit integers.

    A null or empty text has no ids. Rows keep their number and order; other columns are ignored.
    `path` must be readable on each executor, as an installed package is.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                ids = pa.array(coder.encode(texts), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"]
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows of `encoded` (doc_id, ids) with the bytes that the ids stand for, as `decoded`."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, public_tokenizers.PATTERN)
        for batch in batches:
            ids = batch.column(1)
            texts = pa.array([coder.decode(x.as_py()) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, texts], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes each text, decodes its ids, and keeps the digests of both.

    Both ways in one pass, so that a task has one Python worker with one vocabulary.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, public_tokenizers.PATTERN)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                encoded = coder.encode(texts)
                columns = (
                    pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                    pa.array([sha256(ids).hexdigest() for ids in encoded], pa.string()),
                    pa.array([sha256(coder.decode(ids)).hexdigest() for ids in encoded], pa.string()),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *columns],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
