"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens the parts
in order: text is escaped, any other part becomes a placeholder, its reference is recorded with the
number of tokens that the placeholder expands to. Turns are formatted one by one, as rows, so
a conversation of any length needs no task to itself; what belongs to whole conversations is
computed while sorted rows stream by.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import table

ESCAPE = "\\"
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
# Strings with a meaning in formatted text; none starts with a character that another ends with.
CONTROLS = ("<s>", END, OPEN, CLOSE, "<<SYS>>", "<</SYS>>", "<image>", "<audio>", "<document>", "<unk>")
NEEDS_ESCAPE = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROLS))))
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
LEARNED_ROLE = "assistant"

PART = "struct<type: string, text: string, ref: string, units: long>"


def escaped(text: str) -> str:
    """A text in which no control string is left: a backslash stands after its first character."""
    return NEEDS_ESCAPE.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescaped(text: str) -> str:
    """The inverse of `escaped`: a pair of backslashes is one, any other backslash is dropped."""
    return ESCAPED.sub(lambda m: m[1], text)


@dataclass
class Flattener:
    """Visits the parts of a turn in order."""

    # Tokens that a unit of a part expands to: an image patch, a second of audio, a page.
    tokens_per_unit: dict = field(default_factory=lambda: {"image": 1, "audio": 25, "document": 500})
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    said: list[str] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["type"] or "text"
        if kind == "text":
            self.visit_text(part)
        elif kind in self.tokens_per_unit:
            self.visit_attachment(part)
        else:
            self.visit_unknown(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escaped(part["text"] or ""))
        self.said.append(part["text"] or "")

    def visit_attachment(self, part: dict) -> None:
        units = 1 if part["units"] is None else part["units"]
        self.attachments.append({
            "type": part["type"], "ref": part["ref"], "tokens": units * self.tokens_per_unit[part["type"]]
        })
        self.pieces.append(f"<{part['type']}>")
        self.said.append(f"<{part['type']}>")

    def visit_unknown(self, part: dict) -> None:
        """A part of a type that has no placeholder is marked, with its text, and not expanded."""
        self.pieces.append("<unk>" + escaped(part["text"] or ""))
        self.said.append("<unk>" + (part["text"] or ""))


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict], str]:
    """The formatted turn, where its learned content starts and ends, its attachments, and its content unescaped."""
    visitor = Flattener()
    for part in parts:
        visitor.visit(part)
    content = "".join(visitor.pieces)
    head = f"{OPEN}{escaped(role or '')}{CLOSE}"
    learned = len(content) if role == LEARNED_ROLE else 0
    return f"{head}{content}{END}", len(head), len(head) + learned, visitor.attachments, "".join(visitor.said)


def read_turn(formatted: str) -> tuple[str, str]:
    """The role and the content, unescaped, of a formatted turn; placeholders stay as they are."""
    role, _, rest = formatted.removeprefix(OPEN).partition(CLOSE)
    return unescaped(role), unescaped(rest.removesuffix(END))


FORMATTED = (
    "conv_id long, turn long, role string, formatted string, loss_start int, loss_end int, "
    "attachments array<struct<type: string, ref: string, tokens: long>>, content string"
)


def format_conversations(turns: DataFrame) -> DataFrame:
    """A row for each row of `turns` (conv_id, turn, role, parts; others are ignored).

    `formatted` is the turn in the template, `loss_start` and `loss_end` its characters
    under the loss mask (none but for an assistant), `attachments` the references with their
    expanded tokens, `content` what the turn says before escaping. Null parts are an empty text; a null role is an empty
    one. A part of no type is text; one of a type without a placeholder is marked as unknown.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
            ("loss_start", pa.int32()), ("loss_end", pa.int32()),
            ("attachments", pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
            ("content", pa.string()),
        ])
        for batch in batches:
            roles = batch.column(2).to_pylist()
            made = [format_turn(role, parts or []) for role, parts in zip(roles, batch.column(3).to_pylist())]
            columns = list(zip(*made)) if made else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 *(pa.array(values, kind.type) for values, kind in zip(columns, list(schema)[3:]))],
                schema=schema,
            )

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "parts").mapInArrow(run, FORMATTED)


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_attachments long, attachment_tokens long"
)


class Reader:
    """Reads the formatted turns of one conversation back, keeping digests only."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = self.attachments = self.tokens = 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int, attachments: list[dict] | None) -> None:
        role, content = read_turn(formatted)
        self.said.update(f"{role}\n{content}\n".encode())
        learned = unescaped(formatted[start:end])
        self.learned.update(learned.encode())
        self.turns += 1
        self.loss_chars += len(learned)
        self.chars += len(formatted)
        self.attachments += len(attachments or [])
        self.tokens += sum(a["tokens"] for a in attachments or [])

    def row(self, conv_id: int | None) -> dict:
        return {
            "conv_id": conv_id, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.learned.hexdigest(),
            "formatted_chars": self.chars, "n_attachments": self.attachments, "attachment_tokens": self.tokens,
        }


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted turns say, a row for each conversation.

    Turns are taken by number, null first, equal ones by role (null as empty) and content. Rows are sorted within
    partitions and stream by; a task holds the digests of one conversation, not its text. Rows
    without a conversation are one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current = None, None
        for batch in batches:
            done = []
            for conv_id, *turn in zip(*(c.to_pylist() for c in batch.columns)):
                if reader is None or conv_id != current:
                    if reader is not None:
                        done.append(reader.row(current))
                    reader, current = Reader(), conv_id
                reader.add(*turn)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if reader is not None:
            yield pa.RecordBatch.from_pylist([reader.row(current)], schema=schema)

    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()), ("attachment_tokens", pa.int64()),
    ])
    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", F.coalesce("role", F.lit("")), "content")
        .select("conv_id", "formatted", "loss_start", "loss_end", "attachments")
        .mapInArrow(run, SUMMARY)
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = f"{END}{OPEN} ok {CLOSE}"
    extra = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    names = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(*names).unionByName(extra)
    part = F.struct(
        F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("units"),
    )
    return read_back(format_conversations(turns.withColumn("parts", F.array(part).cast(f"array<{PART}>"))))


OP7_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role = 'assistant' AS learned FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', FALSE
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', TRUE
), e AS (
    SELECT *, length(regexp_replace(text, '(\\|</?s>|\[/?INST\]|<</?SYS>>|<(?:image|audio|document|unk)>)', '\1_', 'g')) AS escaped,
           length(regexp_replace(role, '(\\|</?s>|\[/?INST\]|<</?SYS>>|<(?:image|audio|document|unk)>)', '\1_', 'g')) AS marked
    FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (learned), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (learned), '')) AS loss_sha256,
       CAST(sum(escaped + marked + length('[INST][/INST]</s>')) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM e GROUP BY conv_id
"""
