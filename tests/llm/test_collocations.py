"""Collocations against plain counting of every phrase."""

import re
from collections import Counter

import numpy as np
import pytest

from pricelab.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string, source string, n int, words int, phrase string, f long, gram string"
ENDS, WORD = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[^ \t]+")


def plain(rows, min_count, max_words=5, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in ENDS.split(lower):
            words = WORD.findall(piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", *words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    out = []
    for g, a in f.items():
        lang, words = g[0], g[1:]
        if len(words) < 2 or a < min_count:
            continue
        if any(o[0] == lang and len(o) > len(g) and c >= a and any(o[i : i + len(words)] == words for i in range(1, len(o))) for o, c in f.items() if c >= min_count):
            continue
        score, k = min((1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang]))
    got, seen = set(), Counter()
    for lang, score, a, phrase, l, r, total in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            got.add((lang, seen[lang], phrase.decode(), -a, l, r, total, -score))
    return got


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, "p", 3, "g") for i, t, lang in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = ["the", "New", "York", "city", "of", "é", "É", "a", "b", "x-ray", "I\x1ci", "rare"] + [f"w{i}" for i in range(40)]
    p = np.array([8, 4, 4, 3, 6, 2, 2, 3, 3, 2, 1, 1] + [0.5] * 40)
    out = []
    for i in range(160):
        text = " ".join(rng.choice(words, int(rng.integers(0, 120)), p=p / p.sum()))
        text = text.replace(" a ", ". A\t\t", 1) + ["", " New York City of the", ",new york city of the world:", "\r\nof  the of the of the of the"][i % 4]
        out.append((i, text, ["en", "en", "en", "de", None, "und"][i % 6]))
    return out + [(None, None, "en"), (1, "", "en"), (2, " \t..", "xx"), (3, "of the " * 4000, "en"), (3, "of the " * 400, "long"), (4, out[4][1], "en"), (4, out[4][1], "en")]


@pytest.mark.parametrize("min_count, top", [(5, 2000), (12, 30), (300, 2000)])
def test_against_plain_counts(spark, rows, min_count, top):
    got = col.collocations(make(spark, rows), min_count, top=top).collect()
    assert len(got) == len({(r["lang"], r["rank"]) for r in got})
    assert {tuple(r) for r in got} == plain(rows, min_count, top=top)


def test_small_caches_and_a_crowded_bitmap(spark, rows, monkeypatch):
    """Sent in many parts, with a bitmap in which most bits are set: counts stay exact."""
    for name, value in [("KEPT_WORDS", 30), ("HELD_PAIRS", 200), ("RANGE_BYTES", 1000)]:
        monkeypatch.setattr(col, name, value)
    frequent = col.frequent_pairs
    monkeypatch.setattr(col, "frequent_pairs", lambda r, m: frequent(r, m, 12))
    cut = col.edges
    monkeypatch.setattr(col, "edges", lambda r, b, w: cut(r, b, w, 12))
    assert {tuple(r) for r in col.collocations(make(spark, rows), 6).collect()} == plain(rows, 6)


def test_empty_tables(spark):
    assert col.collocations(make(spark, [])).collect() == []
    assert col.collocations(make(spark, [(1, None, None), (2, " .", "en")]), 1).collect() == []
