from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from helpers import documents, frame, plain, prose

from tripmarts.llm import repeats


def slow(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fast(spark, rows, depth, crowd):
    found = repeats.without_repeats(frame(spark, rows), depth, crowd).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    return sorted(((r[0], *r[1:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in found.collect()), key=repr)


@pytest.mark.parametrize("crowd", [1, 4096])
@pytest.mark.parametrize("length, gram", [(200, 64), (40, 9)])
def test_equals_brute_force(spark, length, gram, crowd, monkeypatch):
    # Short stretches, so that texts span several.
    monkeypatch.setattr(repeats, "CONTEXT_BYTES", 5000)
    rng = random.Random(length)
    rows = documents()
    passage = prose(rng, 8)
    for i in range(12):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        rows.append((500 + i, prose(rng, 3) + passage[a:b] + prose(rng, 3), "en", "s1", None))
    rows += [(600, "=" * 700, None, None, None), (601, "ab" * 300, None, None, None), (602, "x" + "=" * 230, None, None, None)]
    expected = sorted(((r[0], *s) for r, s in zip(rows, slow([r[1] for r in rows], length))), key=repr)
    assert any(0 < e[2] < e[1] for e in expected)
    assert fast(spark, rows, repeats.Depth(length, gram), crowd) == expected


def test_long_texts_span_stretches():
    rng = random.Random(1)
    data = bytes(rng.choices(range(97, 123), k=3 * repeats.STRETCH // 2))
    depth = repeats.Depth()
    starts = set()
    for g, c, place, near, far in repeats.anchors(data, depth):
        for p, a, b in zip(place.tolist(), near.tolist(), far.tolist()):
            own = range(p - b, p - a + 1)
            assert not starts & set(own) and 0 <= a <= b <= depth.length - depth.gram
            starts |= set(own)
    assert starts == set(range(len(data) - depth.length + 1))


def test_text_keeps_whole_characters_and_other_columns(spark):
    passage = "é" * 150
    rows = [(1, "A" + passage + "B" * 9, "x", "s", 3), (2, "ü" + passage + "C" * 9, "y", None, 4)]
    cut = repeats.without_repeats(frame(spark, rows), as_text=True).orderBy("rest.doc_id").collect()
    assert [r.kept for r in cut] == ["A" + "B" * 9, "ü" + "C" * 9]
    assert cut[1]["rest"]["n_chars"] == 4 and cut[1]["rest"]["source"] is None
    clash = frame(spark, [(1, "a", 5, 6)], "doc_id long, text string, `row` long, spans long")
    assert repeats.without_repeats(clash).first()["rest"]["row"] == 5
    assert repeats.without_repeats(frame(spark, [])).count() == 0


def test_short_texts_stay(spark):
    found = plain(repeats.without_repeats(frame(spark, [(1, "same", "", "", 0), (2, "same", "", "", 0)])).select("n_removed", "n_spans"))
    assert found == [(0, 0), (0, 0)]


def test_one_id_on_many_texts(spark):
    rng = random.Random(31)
    passage = prose(rng, 6)
    rows = [(7, prose(rng, rng.randint(2, 4)) + (passage[i % 40 :] if i % 2 else "") + prose(rng, 2), "", "", 0) for i in range(1500)]
    rows += [(None, rows[1][1], "", "", 0), (0, rows[1][1], "", "", 0), (None, rows[0][1] + "x", "", "", 0)]
    expected = sorted(((r[0], *s) for r, s in zip(rows, slow([r[1] for r in rows], 200))), key=repr)
    assert fast(spark, rows, repeats.Depth(), repeats.CROWD) == expected


@pytest.mark.parametrize("length", [3, 8, 21, 200])
def test_windows_sorted_by_their_bytes(length):
    rng = random.Random(length)
    parts = [bytes(rng.choices(b"ab", k=rng.randint(length, length + 30))) for _ in range(40)] + [b"a" * (length + 50)] * 2
    raw = b"".join(parts)
    starts, group, at = [], [], 0
    for number, part in enumerate(parts):
        starts += range(at, at + len(part) - length + 1)
        group += [number // 9] * (len(part) - length + 1)
        at += len(part)
    seen = collections.Counter((g, raw[s : s + length]) for g, s in zip(group, starts))
    expected = [i for i, (g, s) in enumerate(zip(group, starts)) if seen[g, raw[s : s + length]] > 1]
    found = repeats.in_equal_groups(raw, np.array(starts), np.array(group), length)
    assert sorted(found.tolist()) == expected
