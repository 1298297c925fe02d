from __future__ import annotations

import collections
import random
import re
import unicodedata

import pytest
import regex
from helpers import documents, frame, prose, sentence, words

from tripmarts.llm import mixing, quality
from tripmarts.llm.common import stored


def base_counts(text):
    found = words(text)
    grams = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    seen = collections.Counter(grams)
    covered = {i + k for i, gram in enumerate(grams) if seen[gram] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_equal_brute_force(spark):
    rows = documents() + [(900, "a b c a b c a b", None, None, 0), (901, "x x x x", None, None, 0), (902, "p q\np q\n\np q", None, None, 0)]
    found = quality.line_first(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        q = row.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base_counts(row.text)
        failed = q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words
        assert q.base_failed == failed and not (failed and q.kept)


def test_bad_lines_go_and_clean_documents_stay(spark):
    clean = prose(random.Random(1), 9) + "\n"
    rows = [
        (1, clean, "x"),
        (2, clean + "Home | News | Sport\nAll rights reserved.\nno end here", "x"),
        (3, "Home | News | Sport | Weather | Travel pages\n" * 3 + "menu entry without an end\n" * 30 + clean[:100], "x"),
        (4, "BUY!! NOW!! ONLY!! TODAY!!\n" * 30, "x"),
    ]
    found = {r.doc_id: r for r in quality.line_first(frame(spark, rows, "doc_id long, text string, quality string")).collect()}
    assert found[1].quality.kept and found[1].quality.n_bad_lines == 0
    assert found[2].quality.kept and found[2].quality.n_bad_lines == 3
    assert found[2].quality.cleaned == found[1].quality.cleaned
    assert not found[3].quality.kept and not found[4].quality.kept


LINES = {
    "hi": "यह एक साफ़ वाक्य है जो किसी समाचार लेख से लिया गया है।",
    "ur": "یہ ایک صاف جملہ ہے جو کسی خبر کے مضمون سے لیا گیا ہے۔",
    "ar": "هل هذه جملة نظيفة مأخوذة من مقال إخباري طويل؟",
    "zh": "这 是 一 句 干 净 的 话。",
    "ja": "「これは きれいな 文 です か？」",
    "zh2": "他 们 说 这 是 真 的！",
    "am": "ይህ ከዜና ጽሑፍ የተወሰደ ንጹህ ዓረፍተ ነገር ነው።",
    "hy": "Սա մաքուր նախադասություն է լուրերից։",
    "my": "ဤသည် သန့်ရှင်းသော စာကြောင်း ဖြစ်သည်။",
    "km": "នេះ ជា ប្រយោគ ស្អាត មួយ ។",
    "el": "Είναι αυτή μια καθαρή πρόταση\u037e",
    "fr": "Elle a dit « bonjour » puis il a dit « bonsoir » et tous sont partis.",
    "fr2": "Il a répondu : « Nous viendrons demain matin. »",
    "de": "Er sagte: „Wir kommen morgen.“",
    "ca": "El col·legi i la novel·la són a la ciutat.",
    "th": "นี่คือประโยคที่สะอาดซึ่งนำมาจากบทความข่าวยาวเรื่องหนึ่งและไม่มีเครื่องหมายจบประโยค",
}


@pytest.mark.parametrize("name", sorted(LINES))
def test_clean_documents_of_each_script_stay(spark, name):
    """A number after each second word, so that no passage repeats."""
    pairs = re.findall(r"\S+(?: \S+)?", LINES[name])
    lines = [f"{i} " + "".join(f"{pair} {i}x{k} " for k, pair in enumerate(pairs[:-1])) + pairs[-1] for i in range(12)]
    if name == "th":
        lines = [LINES["th"] * 2]
    found = quality.line_first(frame(spark, [(1, "\n".join(lines), name, "s", 0)])).first().quality
    assert found.n_bad_lines == 0 and found.cleaned == "\n".join(lines)
    assert found.kept


def test_many_words_need_no_final_mark(spark):
    text = " ".join(f"word{i}" for i in range(60))
    found = quality.line_first(frame(spark, [(1, text, "en", "s", 0), (2, "menu » pages » home.\n" + text, "en", "s", 0)])).orderBy("doc_id").collect()
    assert [r.quality.kept for r in found] == [True, True]
    assert [r.quality.cleaned for r in found] == [text, text]


@pytest.mark.parametrize("odd", [
    "left | right | centre", "one · two • three", "our privacy policy", "sign in to", "wow!! oh!! no!!", "## ** && %%",
])
def test_a_few_marks_or_one_phrase_leave_a_long_line(spark, odd):
    article = sentence(random.Random(7), 1500)[:-1] + f" {odd} " + sentence(random.Random(8), 1500)
    rows = [(1, article, "en", "s", 0), (2, f"{odd} here.\n{article}\n{odd} there.", "en", "s", 0)]
    found = quality.line_first(frame(spark, rows)).orderBy("doc_id").collect()
    assert [(r.quality.kept, r.quality.n_bad_lines, r.quality.cleaned) for r in found] == [(True, 0, article), (True, 2, article)]


def test_quality_of_an_empty_table_and_other_columns(spark):
    assert quality.line_first(frame(spark, [])).count() == 0
    rows = [(1, "a. b.", 3, "keep")]
    found = quality.line_first(frame(spark, rows, "doc_id long, text string, n_words int, `od.d` string")).first()
    assert found["n_words"] == 3 and found["od.d"] == "keep" and found.quality.n_words == 2


def test_a_text_is_judged_once_and_names_may_clash(spark):
    wide = "doc_id long, text string, __words string, __lines int, judged int, words int"
    rows = [(1, prose(random.Random(4), 9), "w", 1, 2, 3), (2, "no", "w", 1, 2, 3)]
    kept = quality.only_kept(quality.line_first(frame(spark, rows, wide)))
    assert [(r.doc_id, r["__words"], r.words) for r in kept.collect()] == [(1, "w", 3)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    conditions = [line for line in plan.split("\n") if re.match(r"[ :+*()\d-]*Filter ", line)]
    assert not any("rlike" in c.lower() or "regexp" in c for c in conditions)


SLOW_UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u19e0-\u19ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u303b\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"


def slow_line_fails(line):
    """The rules for a line once more, with the patterns of another library."""
    def count(pattern):
        return len(regex.findall(pattern, line))

    n = count(rf"[{SLOW_UNSPACED}]{{1,2}}|[\p{{L}}\p{{N}}][^\x20\x09-\x0D{SLOW_UNSPACED}]*")
    closing = "\"'\uff02\uff07"
    at = line[-64:]
    while at and (at[-1] in closing or unicodedata.category(at[-1]) in ("Pe", "Pf", "Pi", "Zs", "Zl", "Zp", "Cf") or at[-1] in "\t\n\x0b\x0c\r\x85"):
        at = at[:-1]
    if n < 20 and not (at and at[-1] in quality.END_MARKS):
        return True
    marks = sum(c in "|•" or (c == "·" and not line[i + 1 : i + 2].isalpha()) for i, c in enumerate(line))
    marks += 0 if "«" in line else line.count("»")
    for found, least, each in ((marks, 2, 10), (count("!!+"), 3, 10), (count(r"[#*$%&|<>]{2,}"), 3, 10), (len(re.findall(quality.Rules.boilerplate, line.lower())), 1, 30)):
        if found >= least and n < found * each:
            return True
    return False


def test_line_rules_equal_brute_force(spark):
    rng = random.Random(77)
    pieces = [
        "word", "Satz", "col·legi", "·", " · ", "|", "•", "»", "« ", "!!", "!", "##", "$%", "<>", ".", "?", "。", "।", "”", ")", "’", " ", " ", " ",
        "漢字", "ไทย", "Privacy Policy", "copyright 2", "Copyright (c)", "\t", "\u3000", "\u2009", "…", "9", "«", "é", "Sign in to", "x " * 12, "\x85",
    ]
    lines = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(1500)]
    lines = [line for line in lines if words(line)]
    rows = [(i, line) for i, line in enumerate(lines)]
    found = {r.doc_id: r.quality.n_bad_lines for r in quality.line_first(frame(spark, rows, "doc_id long, text string")).collect()}
    expected = {i: int(slow_line_fails(line)) for i, line in rows}
    assert {i: lines[i] for i in found if found[i] != expected[i]} == {}
    assert 100 < sum(expected.values()) < len(lines) - 100


def targets(sizes: dict, curriculum) -> dict:
    """Water-filling in rounds: give by weight, cap, reshare."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, active = 1.5 * sum(sizes.values()), set(names)
    while active:
        share = left / sum(weight[s] for s in active)
        full = {s for s in active if weight[s] * share >= 2 * sizes[s]}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        active -= full
        if not full:
            target |= {s: weight[s] * share for s in active}
            break
    return target


def test_targets_and_takings(spark):
    rows = documents(count=60)
    plan = mixing.curriculum_plan(mixing.with_size(frame(spark, rows))).collect()
    sizes = collections.Counter()
    for row in rows:
        sizes[row[3]] += len(words(row[1]))
    wanted = targets(sizes, mixing.Curriculum())
    taken = collections.Counter()
    assert len(plan) == len(rows)
    for row in plan:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(wanted[row.source])
        used = sum(c.words for c in row.copies)
        assert used <= 2 * row.size and all(0 < c.words <= row.size for c in row.copies)
        taken[row.source] += used
    for source, words_taken in taken.items():
        assert abs(words_taken - wanted[source]) <= 1


def test_training_order_follows_the_schedules(spark):
    rows = [(i, "w " * 10, "en", "abc"[i % 3], 0) for i in range(900)]
    plan = stored(mixing.curriculum_plan(mixing.with_size(frame(spark, rows))))
    order = [(r.source, r.copy.position, r.copy.words) for r in mixing.in_training_order(plan).collect()]
    positions = [p for _, p, _ in order]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    # The schedule of the first source falls from 7.5 to 2.5: 5/8 of its words are due by half time.
    first = [(p, w) for s, p, w in order if s == "a"]
    due = sum(w for p, w in first if p < 0.5) / sum(w for _, w in first)
    assert due == pytest.approx(0.625, abs=0.02)
    third = [(p, w) for s, p, w in order if s == "c"]
    assert sum(w for p, w in third if p < 0.5) / sum(w for _, w in third) == pytest.approx(0.375, abs=0.03)


def test_mixing_reruns_agree_and_handles_nothing(spark):
    docs = mixing.with_size(frame(spark))
    again = frame(spark, documents()[::-1])
    once = sorted(map(repr, mixing.curriculum_plan(docs).collect()))
    assert once == sorted(map(repr, mixing.curriculum_plan(mixing.with_size(again)).collect()))
    assert mixing.curriculum_plan(mixing.with_size(frame(spark, []))).count() == 0
    clash = frame(spark, [(1, "a b", "s", 9.0, "t")], "doc_id long, text string, source string, target double, copies string")
    row = mixing.curriculum_plan(mixing.with_size(clash)).first()
    assert row.target == 3.0 and row.source_size == 2
    names = "doc_id long, __ticket string, size long, __bucket int, source string, row int, number int, __in int"
    row = mixing.curriculum_plan(frame(spark, [(1, "t", 2, 3, "s", 4, 5, 6)], names)).first()
    assert tuple(row)[:8] == (1, "t", 2, 3, "s", 4, 5, 6) and row.source_size == 2


def test_first_words_keep_their_spaces(spark):
    text = "  one\ttwo \n three  four "
    found = spark.createDataFrame([(text,)], "text string").select(mixing.first_words(mixing.F.col("text"), mixing.F.lit(3))).first()[0]
    assert found == "  one\ttwo \n three"
