"""Secrets in texts: known forms, and strings of high entropy by sliding windows.

Known forms are patterns. Beyond these, maximal runs of token characters are candidates, and each is
scanned per character class: within every stretch of the class, the Shannon entropy of a window is kept
up to date from the counts of its characters, one entering and one leaving at a time. Windows above the
threshold of the class, joined where they touch, are findings, unless the candidate or the
finding is on the allow-list. Entropies are whole multiples of 2^-32, so no rounding adds up.

A pass over the texts, without a shuffle; a text is scanned whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import table

ONE = 1 << 32
# Finding kinds of known forms, in the order in which equal starts are listed.
KNOWN = ("assign", "access", "hex")

ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
# A run that is too short fails from each of its characters, so the least length can be asked at once.
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
ASSIGNED_AT_LEAST = 8


@dataclass(frozen=True)
class CharacterClass:
    """Stretches of `characters` with a window of `size` of at least `bits` of entropy a character."""

    name: str
    characters: str
    size: int
    bits: float
    # A finding holds characters of each of these.
    needs: tuple[str, ...] = ()


# Windows of 24: a random one has some 3.5 bits in hex and 4.2 in base 64, joined words have 3.6 at most.
CLASSES = (
    CharacterClass("entropy_hex", "[0-9A-Fa-f]", 24, 3.0, ("[0-9]", "[A-Fa-f]")),
    CharacterClass("entropy_base64", "[A-Za-z0-9+/]", 24, 3.9, ("[0-9]", "[A-Z]", "[a-z]")),
    CharacterClass("entropy_base64url", "[A-Za-z0-9_-]", 24, 3.9, ("[0-9]", "[A-Z]", "[a-z]")),
)

# Candidates that are no secrets: words joined by marks, paths; words joined by capitals; identifiers (UUID); numbers;
# placeholders and rows of the alphabet. Repetition is possessive where it could be read in several ways.
ALLOWED = (
    r"[A-Za-z]{0,20}(?:[/_.+=-][A-Za-z]{0,20}|[0-9]{1,4}(?![0-9]))*",
    r"(?:[A-Z]{0,2}[a-z]{2,}+[0-9]{0,2}+|[A-Z][a-z](?=[A-Z]))++",
    r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}",
    r"[0-9+/=_-]*",
    r"(?i:.*(?:example|placeholder|changeme|dummy|xxxx|abcdefgh|01234567).*)",
)


@dataclass(frozen=True)
class Scan:
    """What counts as a finding beyond the known forms."""

    candidate: str = "[A-Za-z0-9+/=_-]"
    classes: tuple[CharacterClass, ...] = CLASSES
    allowed: tuple[str, ...] = ALLOWED
    shortest: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "shortest", min((c.size for c in self.classes), default=0))


def terms(size: int) -> list[int]:
    """c log2 c for each count up to the size of a window, as multiples of 2^-32."""
    return [0] + [round(c * math.log2(c) * ONE) for c in range(1, size + 1)]


def high_windows(text: str, size: int, bits: float, term: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches (start, end) covered by windows whose entropy is at least `bits`, joined where they touch.

    A window's entropy is log2(size) - sum(c log2 c) / size over the counts c of its characters.
    """
    if len(text) < size:
        return
    # A window just at the threshold counts, whatever the rounding of its terms.
    most = (math.log2(size) - bits) * size * ONE + size
    counts = dict.fromkeys(text, 0)
    total = 0
    start = end = None
    for at, entering in enumerate(text):
        first = at - size + 1
        if first > 0:
            leaving = text[first - 1]
            count = counts[leaving]
            counts[leaving] = count - 1
            total += term[count - 1] - term[count]
        count = counts[entering]
        counts[entering] = count + 1
        total += term[count + 1] - term[count]
        if first >= 0 and total <= most:
            if end is None or first > end:
                if end is not None:
                    yield start, end
                start = first
            end = at + 1
    if end is not None:
        yield start, end


class Scanner:
    """Finds spans (start, end, kind) in code points, end exclusive."""

    def __init__(self, scan: Scan = Scan()):
        self.scan = scan
        self.candidates = re.compile(f"{scan.candidate}{{{scan.shortest},}}") if scan.classes else None
        self.allowed = [re.compile(pattern) for pattern in scan.allowed]
        self.classes = [
            (c, re.compile(f"{c.characters}{{{c.size},}}"), [re.compile(n) for n in c.needs], terms(c.size))
            for c in scan.classes
        ]
        self.order = {kind: place for place, kind in enumerate((*KNOWN, *(c.name for c in scan.classes)))}

    def known(self, text: str) -> list[tuple[int, int, str]]:
        found = [
            (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGNED_AT_LEAST
        ]
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
        found += [(*m.span(), "hex") for m in HEX.finditer(text)]
        return found

    def is_allowed(self, text: str) -> bool:
        return any(pattern.fullmatch(text) for pattern in self.allowed)

    def by_entropy(self, text: str) -> Iterator[tuple[int, int, str]]:
        for candidate in self.candidates.finditer(text) if self.candidates else ():
            if self.is_allowed(candidate[0]):
                continue
            for c, stretches, needs, term in self.classes:
                for stretch in stretches.finditer(candidate[0]):
                    for start, end in high_windows(stretch[0], c.size, c.bits, term):
                        found = stretch[0][start:end]
                        if all(n.search(found) for n in needs) and not self.is_allowed(found):
                            at = candidate.start() + stretch.start()
                            yield at + start, at + end, c.name

    def sorted(self, spans: Iterable[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        return sorted(spans, key=lambda span: (span[0], self.order[span[2]], span[1]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_secrets(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """`doc_id` of each row of `docs` (doc_id, text) with its findings (`spans`): by start, then kind.

    A null or empty text has none. Rows stay apart, repeated or not, with or without an id; columns beyond
    these two are not read. Known forms are always reported; the allow-list holds for the others only.
    Spans of different kinds may overlap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(scan)
        kind = pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())
        ]))
        for batch in batches:
            out = []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = [(s, e, k, True) for s, e, k in scanner.known(text)]
                spans += [(s, e, k, False) for s, e, k in scanner.by_entropy(text)]
                out.append([dict(kind=k, start=s, end=e, base=b) for s, e, k, b in scanner.sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, spans {SPANS}")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KNOWN), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
