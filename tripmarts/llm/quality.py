"""Quality rules, line first: bad lines go, then documents that lost too much of their text.

A line is judged alone, by punctuation (does it end like a sentence, is it shouted or full of
symbols), navigation (menu separators) and boilerplate (legal and site phrases). What is left is
the cleaned text. A document is kept if it passes the base rules (length, repetition) and its
bad lines held at most `most_lost` of its characters. Everything is one projection of built-in
functions: no shuffle, one row at a time, linear in the text but for one sort of its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.llm.common import SPACES, let, table, words_of

# Bits of a packed window that hold its position; the rest holds a part of its hash.
POSITION_BITS = 31


# Scripts written without spaces, as ranges of code points: Thai, Lao, Tibetan, Myanmar; Khmer; Han and Kana with
# their marks and extensions. Two of their characters count as a word of a line.
UNSPACED = (
    "฀-႟ក-៿᧠-᧿⺀-⿟々-〇〡-〩〱-〻ぁ-ヿㇰ-ㇿ"
    "㐀-䶿一-鿿ꧠ-꧿ꩠ-ꩿ豈-﫿ｦ-ﾝ\U00020000-\U0003ffff"
)
LINE_WORD = rf"[{UNSPACED}]{{1,2}}|[\p{{L}}\p{{N}}][^{SPACES}{UNSPACED}]*"
# Marks that end a sentence, of Latin, Greek, Armenian, Arabic, Syriac, N'Ko, Indic, Myanmar, Ethiopic,
# Khmer, Mongolian, Tibetan, Meetei, Balinese, Javanese and East Asian texts.
END_MARKS = "….!?:;;։՜՞؟؛۔܀܁܂߹।॥။၊།༎።፧፨។៕᠃᠉᭞᭟꧈꧉꯫‼‽⁇⁈⁉。！？．｡：；︒﹒﹖﹗"
# What may follow such a mark: closing quotes and brackets of any script, also after a space, as in French.
CLOSING = r"\"'＂＇\p{Pe}\p{Pf}\p{Pi}\x09-\x0D\x20\x{85}\p{Z}\p{Cf}"


@dataclass(frozen=True)
class Rules:
    """Limits of the base rules and of the rules for lines, for every script.

    A line of `many_words` needs no mark at its end. Separators, shouts and runs of symbols fail
    a line with fewer than `words_per_mark` words for each of them, site and legal phrases one
    with fewer than `words_per_phrase` for each.
    """

    fewest_words: int = 50
    # What counts as a further word in a text of fewer (None: nothing does).
    unspaced_word: str | None = rf"[{UNSPACED}]{{2}}"
    most_repeated_percent: int = 50
    most_lost: float = 0.5
    # Looked for at the end of a line, in so many characters.
    sentence_end: str = rf"[{END_MARKS}][{CLOSING}]*\z"
    end_characters: int = 64
    many_words: int = 20
    shouts: str = r"!!+"
    symbol_runs: str = r"[#*$%&|<>]{2,}"
    most_shouts: int = 2
    most_symbol_runs: int = 2
    # A · before a letter belongs to a word; » separates in lines without « only, else it is a quotation mark.
    separators: str = r"[|•]|·(?:\P{L}|\z)"
    unquoted_separators: str = "»"
    most_separators: int = 2
    # No line without one of these is asked for marks.
    any_mark: str = r"[|•·»]|!!|[#*$%&<>]{2}"
    # Phrases of a line in lower case.
    boilerplate: str = (
        r"all rights reserved|licen[sc]ed under|released under the|copyright (?:\(c\)|©|\d)"
        r"|terms of (?:use|service)|privacy policy|cookie policy|enable javascript"
        r"|sign in to|subscribe to our"
    )
    words_per_mark: int = 10
    words_per_phrase: int = 30


# The base rules of the query count words only.
OP9_RULES = Rules(unspaced_word=None)


def repeated_window_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the text.

    Windows are packed as (part of a hash, position) and sorted as plain numbers; only those
    whose neighbour has the same hash are compared by their words, so the count is exact.
    """
    low = (1 << POSITION_BITS) - 1

    def packed(w: Column) -> Column:
        starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3))
        hashed = F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.shiftleft(F.xxhash64(w[i], w[i + 1], w[i + 2]), POSITION_BITS)
            .bitwiseOR(i.cast("long")),
        )
        return F.sort_array(hashed)

    def has_twin(items: Column, part) -> Column:
        return F.filter(
            items,
            lambda x, i: F.coalesce(part(x) == part(F.get(items, i - 1)), F.lit(False))
            | F.coalesce(part(x) == part(F.get(items, i + 1)), F.lit(False)),
        )

    def positions(w: Column) -> Column:
        maybe = let(packed(w), lambda p: has_twin(p, lambda x: F.shiftrightunsigned(x, POSITION_BITS)))
        spelled = F.transform(
            maybe,
            lambda x: let(
                x.bitwiseAND(F.lit(low)).cast("int"),
                lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("window"), i.alias("at")),
            ),
        )
        return let(
            F.sort_array(spelled),
            lambda s: F.sort_array(F.transform(has_twin(s, lambda x: x["window"]), lambda x: x["at"])),
        )

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda p, i: F.coalesce(F.least(F.lit(3), F.get(at, i + 1) - p), F.lit(3)))
        return F.aggregate(new, F.lit(0), lambda total, x: total + x)

    return let(words, lambda w: let(positions(w), covered)).cast("long")


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line with a word is removed. Words are counted only where the answer depends on them."""
    words = F.regexp_count(line, F.lit(LINE_WORD))
    unfinished = ~F.right(line, F.lit(rules.end_characters)).rlike(rules.sentence_end) & (words < rules.many_words)
    quoted = F.contains(line, F.lit("«"))
    separators = F.regexp_count(line, F.lit(rules.separators)) + F.when(quoted, 0).otherwise(
        F.regexp_count(line, F.lit(rules.unquoted_separators))
    )

    def dense(count: Column, least: int, words_each: int) -> Column:
        return let(count, lambda n: (n >= least) & (words < n * words_each))

    marked = line.rlike(rules.any_mark) & (
        dense(separators, rules.most_separators, rules.words_per_mark)
        | dense(F.regexp_count(line, F.lit(rules.shouts)), rules.most_shouts + 1, rules.words_per_mark)
        | dense(F.regexp_count(line, F.lit(rules.symbol_runs)), rules.most_symbol_runs + 1, rules.words_per_mark)
    )
    phrased = let(
        F.lower(line),
        lambda low: low.rlike(rules.boilerplate)
        & (words < F.regexp_count(low, F.lit(rules.boilerplate)) * rules.words_per_phrase),
    )
    return unfinished | marked | phrased


def line_first(docs: DataFrame, rules: Rules = Rules(), out: str = "quality") -> DataFrame:
    """Every row with a struct `out`: the base counts, the cleaned text and the verdict.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a
    word), n_bad_lines, lost (share of the characters of such lines that was in bad ones),
    cleaned (lines that passed, joined by newlines), base_failed, kept.

    A null text counts as empty; an empty text has no words, so it is not kept. Equal rows get
    equal answers and stay apart. Other columns pass through, whatever their names; one named `out` is replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))

    def chars(items: Column) -> Column:
        return F.coalesce(F.length(F.array_join(items, "")), F.lit(0))

    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda all_lines: let(
            F.filter(all_lines, lambda x: ~line_fails(x, rules)),
            lambda good: F.struct(
                F.size(all_lines).cast("long").alias("n_lines"),
                (F.size(all_lines) - F.size(F.array_distinct(all_lines))).cast("long").alias("n_dup_lines"),
                (F.size(all_lines) - F.size(good)).cast("long").alias("n_bad_lines"),
                chars(all_lines).alias("chars"),
                chars(good).alias("good_chars"),
                F.array_join(good, "\n").alias("cleaned"),
            ),
        ),
    )

    def verdict(both: Column) -> Column:
        w, of = both["words"], both["lines"]
        further = F.regexp_count(text, F.lit(rules.unspaced_word)) if rules.unspaced_word else F.lit(0)
        few = (w["n_words"] < rules.fewest_words) & (w["n_words"] + further < rules.fewest_words)
        base_failed = few | (100 * w["n_repeat_words"] > rules.most_repeated_percent * w["n_words"])
        lost = F.coalesce(1 - F.try_divide(of["good_chars"], of["chars"]), F.lit(0.0))
        return let(
            F.struct(base_failed.alias("base_failed"), lost.alias("lost")),
            lambda found: F.struct(
                w["n_words"].alias("n_words"),
                w["word_chars"].alias("word_chars"),
                F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                of["n_dup_lines"].alias("n_dup_lines"),
                w["n_repeat_words"].alias("n_repeat_words"),
                of["n_lines"].alias("n_lines"),
                of["n_bad_lines"].alias("n_bad_lines"),
                found["lost"].alias("lost"),
                of["cleaned"].alias("cleaned"),
                found["base_failed"].alias("base_failed"),
                (~found["base_failed"] & (found["lost"] <= rules.most_lost)).alias("kept"),
            ),
        )

    judged = let(F.struct(of_words.alias("words"), of_lines.alias("lines")), verdict)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], judged.alias(out))


def only_kept(judged: DataFrame, out: str = "quality") -> DataFrame:
    """The rows that `line_first` keeps, each judged once: the verdict is no filter that could be copied into the scan."""
    rest = [F.col(f"`{c}`") for c in judged.columns if c != out]
    kept = F.filter(F.array(F.col(f"`{out}`")), lambda q: q["kept"])
    return judged.select(*rest, F.explode(kept).alias(out))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = F.col("quality")
    names = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_bad_lines",
    ]
    return line_first(docs, OP9_RULES).select("doc_id", *[q[name].alias(name) for name in names])


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP9_SQL = (r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), g AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) >= 3)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), j AS (
    SELECT d.*, coalesce(c.n, 0) AS n_repeat_words,
           list_filter(lines, lambda x:
               (regexp_matches(right(x, 64), <END>) OR len(regexp_extract_all(x, <WORD>)) >= 20)
               AND NOT list_bool_or(list_transform(
                   [[len(regexp_extract_all(x, <SEPARATORS>)) + CASE WHEN contains(x, '«') THEN 0 ELSE len(regexp_extract_all(x, '»')) END, 2, 10],
                    [len(regexp_extract_all(x, '!!+')), 3, 10],
                    [len(regexp_extract_all(x, '[#*$%&|<>]{2,}')), 3, 10],
                    [len(regexp_extract_all(lower(x), <PHRASES>)), 1, 30]],
                   lambda r: r[1] >= r[2] AND len(regexp_extract_all(x, <WORD>)) < r[1] * r[3]))
           ) AS good
    FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), n AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
           len(lines) AS n_lines, len(lines) - len(good) AS n_bad_lines,
           coalesce(1 - length(array_to_string(good, ''))::DOUBLE / nullif(length(array_to_string(lines, '')), 0), 0) AS lost
    FROM j
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_bad_lines AS BIGINT) AS n_bad_lines
FROM n
"""
    .replace("<END>", sql_text(Rules.sentence_end)).replace("<WORD>", sql_text(LINE_WORD))
    .replace("<SEPARATORS>", sql_text(Rules.separators)).replace("<PHRASES>", sql_text(Rules.boilerplate))
)
