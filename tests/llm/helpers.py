"""Small documents with what a crawl has: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random
import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
SYLLABLES = "ka lo mi ne pu ra so té vi zo änd ño".split()


def sentence(rng: random.Random, words: int) -> str:
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


def prose(rng: random.Random, lines: int = 6, words: int = 12) -> str:
    return "\n".join(sentence(rng, words) for _ in range(lines))


def documents(seed: int = 5, count: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 12)) for _ in range(count)]
    passage = prose(rng, 5)
    texts += [t + "\n" + passage for t in texts[:4]] + [texts[7], texts[7], texts[8].replace("k", "K", 1)]
    texts += [None, "", " \n\t ", "x", "a b", "word " * 3000, "é" * 1000, prose(rng, 300)]
    texts += ["Home | News | Sport | About\n" + texts[9], "BUY!! NOW!! CHEAP!! BEST!!\n" * 20]
    langs, sources = ["en", "de", None], ["s2", "s10", None, "s1", "é"]
    rows = [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[2], "en", "s1", 7), (None, None, None, None, None)]
    return rows


def frame(spark, rows=None, schema: str = COLUMNS):
    return spark.createDataFrame(documents() if rows is None else rows, schema)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def plain(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)
