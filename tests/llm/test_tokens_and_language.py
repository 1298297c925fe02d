from __future__ import annotations

import hashlib
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, frame, plain, prose

from tripmarts.llm import bpe, hmm, langid

RANKS = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    alphabet = "aAbc eéß\n\t\r\x0b\x1c\x85\xa0​̀ 1²½٣　漢字ⅷ😀👩‍🚀'\"s'll.!?—﻿\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 150)] + ["ab" * n for n in range(1, 80)] + [" " * n for n in range(40)]
    return [*texts, "x" * 20000, "=-" * 9000, "", "<|endoftext|>", prose(rng, 50)]


def test_ids_equal_the_library_and_decode_back():
    coder = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    for texts in (odd_texts(), odd_texts()[::-1]):
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(text), repr(text[:80])
            assert coder.decode(ids) == text.encode()


def test_long_runs_of_one_letter_take_few_steps():
    coder = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    texts = ["a" * 100_000, "ab" * 50_001, "aab" * 30_000, "é" * 40_001]
    began = time.monotonic()
    found = coder.encode(texts)
    assert time.monotonic() - began < 20
    for text, ids in zip(texts, found):
        assert coder.decode(ids) == text.encode()
    for text in ("a" * 3001, "ab" * 1501, "aab" * 1000, "é" * 1501):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == REFERENCE.encode_ordinary(text)


def test_a_worker_forgets_beyond_its_limit(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_REMEMBERED", 5)
    coder = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    for text in ("one two three four five six", "seven one", "one two"):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == REFERENCE.encode_ordinary(text)
    assert len(coder.known) <= 5


def test_merges_where_a_later_token_makes_a_lower_rank_possible():
    # bc (rank 257) is merged only where ab (rank 258) is not; then abc, of rank 256, is possible.
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bc": 257, b"ab": 258, b"aa": 259, b"abcabc": 260}
    library = tiktoken.Encoding("tiny", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(4000)]
    ids, sizes = bpe.replay([w.encode() for w in words], bpe.Merges(ranks))
    for word, part in zip(words, np.split(ids, np.cumsum(sizes)[:-1])):
        assert part.tolist() == library.encode_ordinary(word), word


def test_digests_of_documents(spark):
    rows = documents()
    expected = []
    for doc_id, text, *_ in rows:
        ids = REFERENCE.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert plain(bpe.digests(frame(spark, rows))) == sorted(expected, key=repr)
    assert bpe.digests(frame(spark, [])).count() == 0
    assert bpe.digests(frame(spark, [(1, "a", 2)], "doc_id long, text string, ids int")).first().n_tokens == 1


def languages():
    rng = random.Random(6)
    kinds = {"aa": "la le lo sa se so".split(), "bb": "krz gru bla pfa sch".split(), "cc": "ñi ñu xe xi ço".split()}
    rows = []
    for i in range(150):
        lang = "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2]
        text = " ".join("".join(rng.choices(kinds[lang], k=3)) for _ in range(30))
        rows.append((i, text, lang, "s", 0))
    return rows


def test_language_on_held_out_documents(spark):
    rows = languages()
    docs = frame(spark, rows).withColumn("held_out", langid.fold(3, 1))
    model = langid.fit(docs.filter("NOT held_out"))
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for doc_id, _, lang, *_ in rows:
        assert found[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert found[doc_id].lang_pred == lang and 0 <= found[doc_id].score <= 1


def slow_grams(text, longest, buckets):
    """The buckets of all n-grams, on whole numbers of 64 bits."""
    def wrapped(x):
        return x & (2**64 - 1)

    text = " " + " ".join(text.lower().split()) + " "
    for at in range(len(text)):
        mixed = 0
        for n, letter in enumerate(text[at : at + longest]):
            mixed = wrapped((mixed + ord(letter)) * langid.MULTIPLIERS[n % 3])
            mixed ^= mixed >> 29
            yield wrapped(mixed * langid.MULTIPLIERS[0]) >> (65 - buckets.bit_length())


@pytest.mark.parametrize("longest, buckets", [(2, 256), (3, 1 << 14)])
def test_fit_and_scores_are_naive_bayes(spark, monkeypatch, longest, buckets):
    """Counts, probabilities and posteriors once more, on lists, from the texts alone."""
    monkeypatch.setattr(langid, "CHARACTERS_AT_A_TIME", 50)
    monkeypatch.setattr(langid, "ROWS_AT_A_TIME", 3)
    rows = languages() + [(500, None, "aa", "s", 0), (501, "la le", None, "s", 0), (502, "", "bb", "s", 0)]
    model = langid.fit(frame(spark, rows).repartition(5), langid.Grams(longest, buckets), 0.5)
    counts = {lang: [0.5] * buckets for lang in ("aa", "bb", "cc")}
    for _, text, lang, *_ in rows:
        for bucket in slow_grams(text, longest, buckets) if text is not None and lang is not None else []:
            counts[lang][bucket] += 1
    assert model.languages == sorted(counts)
    logs = {lang: [math.log(x / sum(c)) for x in c] for lang, c in counts.items()}
    texts = [t for _, t, *_ in rows[:20]] + ["lasa krz", "ñi", "", None, "12", "LA  le\n" * 40, "gru ñu"]
    for text, lang, score in zip(texts, *model.predict(texts)):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        totals = {own: sum(logs[own][b] for b in slow_grams(text, longest, buckets)) for own in logs}
        best = max(sorted(totals), key=totals.get)
        assert lang == best
        assert score == pytest.approx(1 / sum(math.exp(x - totals[best]) for x in totals.values()))


def test_grams_do_not_depend_on_where_a_text_is_cut(monkeypatch):
    text = prose(random.Random(2), 20)
    whole = langid.Grams().counts(text)
    assert whole.sum() == sum(len(" ".join(text.split())) + 3 - n for n in (1, 2, 3))
    monkeypatch.setattr(langid, "CHARACTERS_AT_A_TIME", 37)
    assert (langid.Grams().counts(text) == whole).all()


def test_language_of_odd_tables(spark):
    model = langid.fit(frame(spark, languages()))
    wide = frame(spark, [(1, "la le lo", "krz", 1, True, 0.5)], "doc_id long, text string, lang_pred string, score int, held_out boolean, counts double")
    assert [tuple(r)[:3] for r in langid.predict(wide, model).collect()] == [(1, True, "aa")]
    long = "la le lo " * 300_000
    assert model.predict([long, "krz"])[0] == ["aa", "bb"]


def test_undetermined_and_nothing_learned(spark):
    rows = documents() + [(800, "123 !? \n", "en", "s", 0)]
    docs = frame(spark, rows).withColumn("held_out", langid.fold(3, 1))
    found = langid.predict(docs, langid.fit(docs))
    assert found.count() == len(rows)
    assert {r.doc_id for r in found.filter("lang_pred = 'und'").collect()} >= {800}
    nothing = langid.fit(frame(spark, []))
    assert {tuple(r) for r in langid.predict(docs, nothing).select("lang_pred", "score").collect()} == {("und", 0.0)}


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_base_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 3000)
    rows = documents()
    docs = frame(spark, rows).withColumn("held_out", langid.fold(7, 2))
    shape = hmm.Shape(states=3, classes=64, rounds=2)
    found = plain(hmm.score_texts(docs, shape))
    held = [zlib.crc32((str(r[0]) if r[0] is not None else "").encode()) % 7 == 2 for r in rows]
    counts: dict = {}
    for row, out in zip(rows, held):
        for token in tokens(row[1]) if not out else []:
            counts[token] = counts.get(token, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for row, out in zip(rows, held):
        seen = [counts.get(t, 0) for t in tokens(row[1])]
        base = sum(math.log10((c + 1) / (total + distinct + 1)) for c in seen)
        expected.append((row[0], out, len(seen), sum(c > 0 for c in seen), total, base))
    assert len(found) == len(rows)
    for row, other in zip(found, sorted(expected, key=repr)):
        assert row[:5] == other[:5] and row[5] == pytest.approx(other[5]) and row[6] < 0


def all_paths(classes, p):
    """Likelihood and expected counts by summing over every path of states."""
    states = len(p.start)
    total, start = 0.0, np.zeros(states)
    move, emit = np.zeros((states, states)), np.zeros_like(p.emit)
    for number in range(states ** len(classes)):
        path = [number // states**i % states for i in range(len(classes))]
        chance = p.start[path[0]] * p.emit[classes[0], path[0]]
        for a, b, c in zip(path, path[1:], classes[1:]):
            chance *= p.move[a, b] * p.emit[c, b]
        total += chance
        start[path[0]] += chance
        for a, b in zip(path, path[1:]):
            move[a, b] += chance
        for c, a in zip(classes, path):
            emit[c, a] += chance
    return total, start / total, move / total, emit / total


def test_recursions_equal_the_sum_over_all_paths():
    shape = hmm.Shape(states=3, classes=4, stay=0.6)
    rng = np.random.default_rng(1)
    p = hmm.first_parameters(rng.dirichlet(np.ones(5)), shape)
    p.start = rng.dirichlet(np.ones(3))
    sizes = np.array([3, 5, 1, 4, 5])
    classes = rng.integers(0, 5, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    seqs = hmm.Sequences(classes, starts, sizes)
    slow = [all_paths(classes[a : a + n].tolist(), p) for a, n in zip(starts, sizes)]
    assert hmm.forward(seqs, p) == pytest.approx([math.log(s[0]) for s in slow])
    assert seqs.blocks(6) == [(0, 1), (1, 2), (2, 3), (3, 5)] and seqs.blocks(100) == [(0, 5)]
    for at_once in (1, 6, 100):
        found = hmm.Expected.none(shape)
        found.add(seqs, p, at_once)
        for mine, place in ((found.start, 1), (found.move, 2), (found.emit, 3)):
            assert mine == pytest.approx(sum(s[place] for s in slow))


def plain_pass(classes, p):
    """Likelihood and expected counts of one sequence, by unscaled recursions on lists."""
    states, steps = range(len(p.start)), range(len(classes))
    ahead = [[p.start[s] * p.emit[classes[0], s] for s in states]]
    for c in classes[1:]:
        ahead.append([sum(ahead[-1][r] * p.move[r, s] for r in states) * p.emit[c, s] for s in states])
    back = [[1.0 for _ in states]]
    for c in classes[:0:-1]:
        back.insert(0, [sum(p.move[s, r] * p.emit[c, r] * back[0][r] for r in states) for s in states])
    total = sum(ahead[-1])
    move, emit = np.zeros_like(p.move), np.zeros_like(p.emit)
    for t in steps:
        for s in states:
            emit[classes[t], s] += ahead[t][s] * back[t][s] / total
            for r in states if t else ():
                move[r, s] += ahead[t - 1][r] * p.move[r, s] * p.emit[classes[t], s] * back[t][s] / total
    start = np.array([ahead[0][s] * back[0][s] / total for s in states])
    return total, start, move, emit


@pytest.mark.parametrize("words_at_a_time", [7, 1 << 19])
def test_scores_equal_training_and_scoring_on_lists(spark, monkeypatch, words_at_a_time):
    """The class chain by plain recursions, times the chance of each word in its class."""
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 300)
    monkeypatch.setattr(hmm, "SPLIT_BYTES", 100)
    monkeypatch.setattr(hmm.Expected.add, "__defaults__", (words_at_a_time,))
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices("Ab b c dd e\x0bf g é h".split(" "), k=rng.randint(0, 25))), "", "", 0) for i in range(40)] + [(99, None, "", "", 0)]
    shape = hmm.Shape(states=3, classes=5, rounds=2, smoothing=2.0)
    docs = frame(spark, rows).withColumn("held_out", langid.fold(7, 2))
    found = {r.doc_id: r.score for r in hmm.score_texts(docs, shape).collect()}

    texts = {i: tokens(t)[:-1] for i, t, *_ in rows}
    training = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    known = sorted({w for t in texts.values() for w in t})
    classed = spark.createDataFrame([(bytearray(w),) for w in known], "word binary").select("word", hmm.class_of(shape))
    of = {bytes(w): c for w, c in classed.collect()}
    counts = {w: sum(t.count(w) for t in training) for w in known}
    words, kinds = np.zeros(6), np.zeros(6)
    for w in known:
        words[of[w]] += counts[w]
        kinds[of[w]] += counts[w] > 0
    words[5] = len(training)
    overall = (words + 0.5) / (words + 0.5).sum()
    p = hmm.first_parameters(overall, shape)
    for _ in range(shape.rounds):
        passes = [plain_pass([*(of[w] for w in t), 5], p) for t in training]
        start, move, emit = (sum(x[k] for x in passes) for k in (1, 2, 3))
        start, move, emit = start + 1, move + 1, emit + shape.smoothing * overall[:, None]
        p = hmm.Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    for i, text in texts.items():
        chance = plain_pass([*(of[w] for w in text), 5], p)[0]
        within = sum(math.log10((counts[w] + 1) / (words[of[w]] + kinds[of[w]] + 1)) for w in text)
        assert found[i] == pytest.approx(math.log10(chance) + within), i


def test_the_model_is_a_distribution_and_beats_the_base_on_held_out_texts(spark):
    rows = languages()
    docs = frame(spark, rows).withColumn("held_out", langid.fold(7, 2))
    found = hmm.score_texts(docs, hmm.Shape(states=4, classes=256)).filter("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 3 * len(found)
    overall = np.ones(9) / 9
    p = hmm.re_estimated(hmm.Expected.none(hmm.Shape(classes=8)), overall, hmm.Shape(classes=8))
    assert p.emit.sum(axis=0) == pytest.approx(np.ones(12)) and p.move.sum(axis=1) == pytest.approx(np.ones(12))


def test_packing():
    numbers = np.array([0, 1, 255, 256, 2**32 - 1])
    assert hmm.unpack(hmm.pack(numbers)).tolist() == numbers.tolist()
    assert hmm.unpack(hmm.pack(np.empty(0, np.int64))).tolist() == []


def test_scores_of_empty_tables_and_without_training_texts(spark):
    none = frame(spark, []).withColumn("held_out", langid.fold(7, 2))
    assert hmm.score_texts(none, hmm.Shape(states=2, classes=8, rounds=1)).count() == 0
    held = frame(spark, [(1, "a b", "", "", 0), (2, None, "", "", 0)]).selectExpr("*", "true AS held_out")
    found = hmm.score_texts(held, hmm.Shape(states=2, classes=8, rounds=1)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
