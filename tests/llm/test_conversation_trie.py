"""The conversation trie against a plain trie built turn by turn."""

import hashlib
import re
import zlib

import pytest

from pricelab.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, words string, a int, up long, n int, low long"


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
        for d in range(len(full) + 1):
            members.setdefault(full[:d], []).append((c, len(full) == d))
    out = set()
    for node, ms in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in below if not any(o[:-1] == m and o for o in members)]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        ends = ",".join(str(c) for c in sorted(c for c, end in ms if end))
        out.add((min(c for c, _ in ms), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(ms),
                 sum(1 for o in members if o and o[:-1] == node), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], SCHEMA).repartition(4)


def check(spark, rows):
    got = trie.conversation_trie(make(spark, rows)).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == plain(rows)


@pytest.fixture(scope="module")
def rows():
    out = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of  {c % 3 if t < c % 5 else c}") for c in range(0, 90) for t in range(c % 9)]
    out += [(200 + i, t, "user", f"same\n {t}") for i in range(60) for t in range(5)]  # copies
    out += [(300, None, None, None), (300, None, "user", ""), (300, 1, "user", "x"), (300, 1, "user", "x"), (300, 1, "b", "x"), (301, 5, None, "é ü"), (321, 0, "user", "only")]
    out += [(None, 0, "user", "no conversation"), (-3, 0, "user", "below zero"), (-3, 1, "user", "y")]
    out += [(400, t, "user", f"long {t}") for t in range(70)] + [(401, t, "user", f"long {t}") for t in range(65)]
    return out


def test_against_a_plain_trie(spark, rows):
    check(spark, rows)


def test_segments_and_long_lists(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 8)
    monkeypatch.setattr(trie, "ENDS", 7)
    check(spark, rows)


def test_chains_that_hang_deep(spark):
    """Conversation i leaves conversation i - 1 after i turns: chains hang nine deep."""
    check(spark, [(100 * i, t, "user", f"{min(i, t)} {t}") for i in range(1, 10) for t in range(12)])


def test_empty_table(spark):
    assert trie.conversation_trie(make(spark, [])).collect() == []
    assert trie.conversation_trie(make(spark, [(None, 0, "user", "x")])).collect() == []
