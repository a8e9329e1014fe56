"""Sharding and mixing where ids are null or repeated, and the exact draw."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricelab.llm import sharding
from pricelab.llm.mixing import hypergeometric, mix, mixed_documents, mixed_words, targets
from pricelab.llm.sharding import shard_documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mix_row long, __hash string, __h int, size string"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 5, "a", 6, "b") for i, t, s in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("cells", [4096, 2])
@pytest.mark.parametrize("ids", ["null", "one"])
def test_shards_stay_balanced_when_a_hot_group_has_no_ids(spark, ids, cells, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_CELLS", cells)
    monkeypatch.setattr(sharding, "WIDER", 2)
    rng = np.random.default_rng(4)
    rows = [(None if ids == "null" else 7, "hot " * 75, "a") for _ in range(1000)]
    rows += [(100 + i, f"text {i} " + "w" * int(rng.integers(1, 400)), "a") for i in range(2000)]
    rows += [(5000 + i, f"pair {i // 2}", "a") for i in range(200)]
    got = shard_documents(make(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(t) + 1) for i, t, _ in rows)
    total, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert len(total) == 16 and max(total.values()) * 16 <= 1.05 * sum(total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(g) > 1 for g in groups.values()) == 1  # only the group larger than a shard is cut


def test_draws_follow_the_hypergeometric_law():
    rng = np.random.default_rng(1)
    for good, bad, n in [(5, 7, 6), (1, 0, 1), (0, 4, 2), (300, 20, 315), (40, 4000, 17)]:
        got = Counter(hypergeometric(rng, good, bad, n) for _ in range(4000))
        whole = math.comb(good + bad, n)
        for k in range(max(0, n - bad), min(n, good) + 1):
            want = math.comb(good, k) * math.comb(bad, n - k) / whole
            assert abs(got[k] / 4000 - want) < 5 * math.sqrt(want * (1 - want) / 4000) + 1e-3
        assert all(max(0, n - bad) <= k <= min(n, good) for k in got)
    good, bad, n = 3 * 10**9, 5 * 10**9, 2 * 10**9
    draws = np.array([hypergeometric(rng, good, bad, n) for _ in range(60)])
    sd = math.sqrt(n * (3 / 8) * (5 / 8) * (6 / 8))
    assert abs(draws.mean() - 750_000_000) < 5 * sd / math.sqrt(60) and 0.6 * sd < draws.std() < 1.5 * sd


@pytest.fixture(scope="module")
def rows():
    out = [(i, " ".join(f"w{i}x{j}" for j in range(i * 7 % 300)), "abc"[i % 3]) for i in range(60)]
    out += [(None, "no id " * 40, "a")] * 3 + [(3, out[3][1], out[3][2])] * 4 + [(70, None, "a"), (71, " \t", None), (72, "x y", None)]
    return out


def test_mix_against_plain_sums(spark, rows):
    docs = make(spark, rows)
    got = mixed_words(docs).collect()
    size = lambda t: len((t or "").split())
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    names = ["a", "b", "c", None]
    sizes = [sum(size(t) for _, t, s in rows if s == n) for n in names]
    want = targets(sizes)
    assert sum(want) == pytest.approx(1.5 * sum(sizes))
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], r["target"]] += r["taken"]
    for s, t in zip(sizes, want):
        assert abs(taken[s, t] - t) <= 1
    again = mixed_words(make(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, ((r["doc_id"], r["size"], r["taken"]) for r in got))) == Counter((r["doc_id"], r["size"], r["taken"]) for r in again)
    spans = defaultdict(list)  # inside an epoch no word is drawn twice
    for d in mix(docs)[1].collect():
        spans[d["source_no"], d["row"], d["epoch"]].append((d["first_word"], d["first_word"] + d["n_words"]))
    assert all(a[1] <= b[0] for s in spans.values() for a, b in zip(sorted(s), sorted(s)[1:]))


def test_mixed_documents_with_repeated_rows_and_clashing_names(spark, rows):
    docs = make(spark, rows)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    taken = sum(r["taken"] for r in mixed_words(docs).collect())
    assert sum(len(r["text"].split()) for r in got) == taken and all(r["n_chars"] == len(r["text"]) for r in got)
    known = {(i, w) for i, t, _ in rows for w in (t or "").split()}
    assert all((r["doc_id"], w) in known for r in got for w in r["text"].split())
    assert all((r["mix_row"], r["__hash"], r["__h"], r["size"]) == (5, "a", 6, "b") for r in got)
    assert mixed_documents(make(spark, [])).collect() == []
