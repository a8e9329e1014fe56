"""Each operator against a plain version on small tables with nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelab.llm.embedding_dups import near_vectors
from pricelab.llm.exact_dedup import drop_exact_duplicates, exact_groups
from pricelab.llm.mixing import mix, mixed_documents, mixed_words, targets
from pricelab.llm.packing import pack_documents, shortest_pack_first
from pricelab.llm.quality_rules import keep_good, score_quality
from pricelab.llm.queries import byte_bpe
from pricelab.llm.repeats import remove_repeats
from pricelab.llm.secret_scan import find_secrets, scan
from pricelab.llm.sharding import shard_documents
from pricelab.llm import repeats, shingle_join
from pricelab.llm.shingle_join import bitmap, drop_near_duplicates, folded, most_overlap, near_groups
from pricelab.llm.suffix_array import suffix_array
from pricelab.llm.tokens import count_tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, h string, n int, level int"
OPERATORS = [exact_groups, shard_documents, mixed_words, find_secrets, near_groups, remove_repeats, lambda d: count_tokens(d, byte_bpe()), lambda d: pack_documents(d, byte_bpe())]


def make(spark, rows):
    full = [(i, t, "en", s, None if t is None else len(t), "x", "y", 1, 2) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "Gamma", "d", "epsilon", "zeta,", "eta.", "théta", "iota"]
    base = " ".join(rng.choice(words, 400))
    passage = "this passage of more than fifty bytes stands in many of the documents of the table"
    out = [(1, base, "a"), (2, base, "a"), (3, base.replace(" ", "\n ", 3), "a"), (4, base + " one more word", "b"), (5, None, None), (6, "", "a"), (7, " \t", "b")]
    out += [(10 + i, " ".join(rng.choice(words, 30)) + " " + passage + " " + str(i), "c") for i in range(30)]
    out += [(50, "ab" * 9000, "c"), (51, "one two", "b"), (52, "ONE Two", None), (53, "<|endoftext|> a  <|endoftext|>\n\n x", "b")]
    out += [(60, " ".join(rng.choice(words, 9000)), "a"), (None, "no id here but a few words", "a"), (2, base, "a")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).cache()


@pytest.mark.parametrize("op", range(len(OPERATORS)))
def test_empty_tables_and_one_row_each(spark, docs, rows, op):
    assert OPERATORS[op](make(spark, [])).collect() == []
    assert OPERATORS[op](docs).select("doc_id").where("doc_id is null").count() >= 1


def test_exact_groups(docs, rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    got = exact_groups(docs, block_bytes=64).collect()  # long texts take many levels
    assert len(got) == len(rows)
    for r in got:
        group = [(i, t) for i, t, _ in rows if hashlib.sha256(norm(t).encode()).hexdigest() == r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == min((i for i, _ in group if i is not None), default=None)
    assert sum(r.kept for r in got) == len({norm(t) for _, t, _ in rows})
    assert [tuple(r) for r in exact_groups(docs).orderBy("doc_id", "kept").collect()] == [tuple(r) for r in exact_groups(docs, 64).orderBy("doc_id", "kept").collect()]
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len({norm(t) for _, t, _ in rows})


def test_near_groups(docs, rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = [(i, shingles(t)) for i, t, _ in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (p, (_, x)), (q, (_, y)) in itertools.combinations(enumerate(sets), 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            root[find(q)] = find(p)
    low = {}
    for p, (i, _) in enumerate(sets):
        if i is not None:
            low[find(p)] = min(low.get(find(p), i), i)
    want = sorted((i or -1, len(s), low.get(find(p)) or -1) for p, (i, s) in enumerate(sets))
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in near_groups(docs).collect()) == want
    left = [r.doc_id for r in drop_near_duplicates(docs).collect()]
    assert 1 in left and not {2, 3, 4, 52} & set(left) and {5, 6, 7} <= set(left)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    """One row of each group goes on, whatever ids its rows have; unrelated rows with the same id or none stay."""
    text = lambda k: " ".join(f"w{k}_{j}" for j in range(80))
    rows = [(1, text(1), "a"), (None, text(1) + " more", "a"), (None, text(2), "a"), (None, "", "a"), (None, None, "a"), (None, " ", "a")]
    rows += [(None, text(3), "a"), (None, text(3) + " more", "a"), (None, text(3) + " again", "a")]  # no row has an id
    rows += [(4, text(4), "a"), (5, text(4) + " more", "a"), (5, text(5), "a"), (5, "", "a")]  # 5 is dropped for one of its texts
    rows += [(6, text(6), "a"), (6, text(6), "a"), (7, text(6) + " more", "a")]  # a row twice
    rows += [(8, text(8), "a"), (8, text(8) + " more", "a"), (None, text(9), "a"), (None, text(9), "a")]  # one id, two near texts
    docs = make(spark, rows)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, (r.text or "").replace(" more", "").replace(" again", "")) for r in left.collect()]
    want = [(1, text(1)), (None, text(2)), (None, ""), (None, ""), (None, " "), (None, text(3)), (4, text(4)), (5, text(5)), (5, ""), (6, text(6)), (8, text(8)), (None, text(9))]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("stars, early", [(3, 24), (0, 24), (0, 1)])
def test_near_groups_large_columns(spark, monkeypatch, stars, early):
    """A family of edited copies far larger than SMALL_COLUMN: one component by chains of links; without
    stars, the pairs across large columns find the rest."""
    monkeypatch.setattr(shingle_join, "STAR_ROUNDS", stars)
    monkeypatch.setattr(shingle_join, "EARLY", early)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.choice(120, 3, replace=False):
            w[k] = f"e{i}_{k}"
        rows.append((i, " ".join(w), "s"))
    rows += [(100 + i, " ".join([*base[:30], *(f"v{i}_{k}" for k in range(40))]), "s") for i in range(40)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t, _ in rows}
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    assert {r.doc_id: r.component_id for r in near_groups(make(spark, rows)).collect()} == low


def test_bitmap_never_undercounts():
    rng = np.random.default_rng(7)
    for n1, n2, both in [(1, 1, 0), (1, 1, 1), (3, 70, 3), (64, 65, 60), (500, 700, 420), (5000, 1200, 900)]:
        values = rng.integers(0, 2**63, n1 + n2 - both, dtype=np.uint64)
        x, y = np.sort(values[:n1]), np.sort(values[n1 - both :])
        bound = most_overlap(n1, bitmap(x), n2, bitmap(y))
        assert both <= bound == most_overlap(n2, bitmap(y), n1, bitmap(x))
        differ = sum(int(v).bit_count() for v in (folded(bitmap(x)) ^ folded(bitmap(y))).view(np.uint64))
        assert bound <= (n1 + n2 - differ) // 2
    assert most_overlap(n1, bitmap(x), n1, bitmap(x)) == n1


def test_repeats(docs, rows):
    seen = {}
    want = []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    key = lambda k: float("inf") if rows[k][0] is None else rows[k][0]
    for k in order:
        raw = (rows[k][1] or "").encode()
        for p in range(len(raw) - 49):
            s = raw[p : p + 50]
            seen[s] = min(seen.get(s, key(k)), key(k))
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if seen[raw[p : p + 50]] < key(k):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        want.append((rows[k][0] or -1, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [(r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs).collect()]
    assert sorted(got) == sorted(want)


def _packed(call, columns, rows):
    """What a batch function yields for rows of these Arrow columns, as one table of pandas rows."""
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), columns)], [f"c{k}" for k in range(len(columns))])
    return pd.concat([b.to_pandas() for b in call([batch])], ignore_index=True)


def test_repeats_of_copies_are_spread():
    """Copies of one text: what comes back for them, settled in a batch or decided, meets in no single group."""
    text = "the one text that a third of all documents hold, word for word and line by line"
    sent = _packed(repeats._marks(1, 50, 1), [pa.int64(), pa.int64(), pa.string()], [(i, 77, text) for i in range(1000)] * 2)
    own = sent[sent["block"] < 0]
    held = own["owner"].map(len).groupby(own["block"]).sum()
    assert len(held) == 50 and held.max() < 3 * held.mean()
    assert int(own["ids"].map(len).sum()) == 1000 * 8  # a repeated row is sent once
    marks = repeats.segments(text.encode())[0].astype(np.uint64)
    low = np.unique(marks).astype(np.uint32)
    sent = _packed(repeats._segments(1, 50, np.zeros(0, dtype=np.uint64)), [pa.int64(), pa.int64(), pa.string(), pa.binary()], [(i, 77, text, low.tobytes()) for i in range(1000)])
    assert (sent["shard"] < 0).sum() == 50
    ids, hs = np.arange(1000), np.full(1000, 77)
    back = repeats._returned(ids, hs, np.arange(1000), {"low": np.zeros(1000, dtype=np.uint32)}, 50)
    assert len(back) == 50 and sorted(np.frombuffer(b"".join(back["ids"]), dtype=np.int64)) == ids.tolist()


def test_repeats_of_a_hot_mark_are_spread():
    """A passage with other text around it in every document: its edges differ under one mark, and no shard gets them all."""
    rng = np.random.default_rng(8)
    passage = "this passage of more than fifty bytes stands in many of the documents of the table"
    texts = [rng.bytes(40).hex() + passage + rng.bytes(40).hex() for _ in range(400)]
    mark = np.concatenate([repeats.segments(t.encode())[0] for t in texts])
    hot, n = np.unique(mark, return_counts=True)
    hot = hot[n >= 50]
    rows = [(i, i, t, np.unique(mark).astype(np.uint32).tobytes()) for i, t in enumerate(texts)]
    mine = [(r[0], r[1], r[2], np.unique(hot).astype(np.uint32).tobytes()) for r in rows]
    sent = _packed(repeats._segments(64, 8, hot), [pa.int64(), pa.int64(), pa.string(), pa.binary()], mine)
    at = sent[sent["shard"] >= 0]
    strings = at["count"].map(len).groupby(at["shard"]).sum()
    assert len(strings) == 64 and strings.max() < 2 * strings.mean()


@pytest.mark.parametrize("hot", [1, 4, 40])
def test_repeats_with_hot_marks(spark, docs, rows, monkeypatch, hot):
    """The same answers when marks are found to be hot, runs of one byte and short periods among them."""
    more = rows + [(200 + i, "x" * i + " " * 300 + "-=" * 60 + str(i) * 80, "a") for i in range(1, 8)]
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 20)
    test_repeats(make(spark, more), more)


def test_suffix_array():
    rng = np.random.default_rng(2)
    for size, symbols in ((1, 2), (2, 2), (50, 2), (400, 3), (3000, 4), (3000, 250)):
        text = rng.integers(0, symbols, size)
        naive = sorted(range(size), key=lambda i: text[i:].tolist())
        assert suffix_array(text, size).tolist() == naive
    runs = np.array([3] * 40 + [1] * 30 + [3] * 40 + [2])
    assert suffix_array(runs, len(runs)).tolist() == sorted(range(len(runs)), key=lambda i: runs[i:].tolist())


def test_tokens_and_packing(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_bpe())
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for _, t, _ in rows]
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, byte_bpe()).collect())
    assert got == sorted((i or -1, len((t or "").encode()), len(x), len(x) > 1024) for (i, t, _), x in zip(rows, ids))
    pieces = pack_documents(docs, byte_bpe()).collect()
    want = []
    for (i, _, _), x in zip(rows, ids):
        x = [*x, 0]
        want += [(i or -1, s, len(x[s : s + 1024]), zlib.crc32(np.array(x[s : s + 1024], dtype="<u4").tobytes()), len(x)) for s in range(0, len(x), 1024)]
    assert sorted((p.doc_id or -1, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == sorted(want)
    for _, group in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        end = 0
        for p in group:
            assert p.offset == end
            end += p.length
        assert end <= 1024


def test_shortest_pack_first():
    histogram = {1024: 3, 700: 5, 300: 7, 20: 50, 4: 9}
    patterns = shortest_pack_first(histogram, 1024)
    assert all(sum(p) <= 1024 and n > 0 for p, n in patterns)
    assert {k: sum(p.count(k) * n for p, n in patterns) for k in histogram} == histogram


def test_mixing(docs, rows):
    assert targets([100, 100, 100], 1.5) == pytest.approx([200, 166.6666667, 83.3333333])
    got = mixed_words(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r.size for r in got) == sorted(size(t) for _, t, _ in rows)
    for target in {r.target for r in got}:
        same = [r for r in got if r.target == target]
        assert abs(sum(r.taken for r in same) - target) <= 0.5
        assert all(r.taken <= 2 * r.size for r in same)
    assert [tuple(r) for r in sorted(mixed_words(docs).collect(), key=str)] == [tuple(r) for r in sorted(got, key=str)]
    _, draws = mix(docs)
    draws = draws.collect()
    assert sorted(d.position for d in draws if d.shard == 0) == list(range(sum(d.shard == 0 for d in draws)))
    unique = docs.dropDuplicates(["doc_id", "text"])
    out = mixed_documents(unique)
    taken = mixed_words(unique).agg(F.sum("taken")).first()[0]
    assert out.columns == docs.columns and sum(size(r.text) for r in out.collect()) == taken


def test_sharding(docs, rows):
    got = shard_documents(docs, 4).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_secrets(spark):
    secret = "Zx9kQ2mB7vT4pL8sW1nR5cY3"
    texts = [f"user=bob then {secret} end", f"nothing near {secret} here", "password=hunter2hunter2 x AKIA" + "A" * 16 + " " + "0f" * 20, "token: abc", None, "é api-key api_key='abcdefgh1' Password : q2w3e4r5t6"]
    got = {r.doc_id: r for r in find_secrets(make(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert (got[0].n_assign, got[0].n_linked) == (0, 2) and f"secret:14:{14 + len(secret)}" in got[0].spans
    assert got[1].spans == "" and got[1].n_linked == 0
    assert (got[2].n_assign, got[2].n_access, got[2].n_hex) == (1, 1, 1)
    base = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in scan(texts[2])[0])
    assert got[2].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[3].n_assign == 0 and got[4].spans == "" and got[5].n_assign == 2


def test_quality(spark):
    good = [(i, f"The cat of house {i} sat on the mat and it was happy there. Another day came.", "s") for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!!! {i} $$$ ### !!! WIN BIG!!", "s") for i in range(30)]
    docs = make(spark, [*good, *bad, (500, None, "s"), (None, good[0][1], "s")])
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad] + [(3, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got if i is not None)
    assert all(got[i].predicted == 1 for i, _, _ in good) and all(got[i].predicted == 0 for i, _, _ in bad)
    assert 0 <= got[500].score <= 1 and got[None].predicted == 1
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and {i for i, _, _ in good} <= {r.doc_id for r in kept.collect()}
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((40, 16))
    near = x[:10] + 0.02 * rng.standard_normal((10, 16))
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*x, *near, x[0], x[0]])]
    rows += [(100, None, 1), (101, [0.0] * 16, 1), (102, [float("nan")] * 16, 1), (103, x[1].tolist(), None), (104, x[1].tolist(), 2), (105, [1.0, None], 1), (106, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    valid = [(i, np.array(np.float32(v), dtype=float), k) for i, v, k in rows if v and k is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {(i, j) for i, v, k in valid for j, w, m in valid if i != j and k == m and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98}
    low = {r[0]: r[0] for r in rows}
    for _ in rows:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    got = {r.vec_id: r for r in near_vectors(frame).collect()}
    assert {i: r.component_id for i, r in got.items()} == low
    assert all(r.n_links == sum(a == i for a, _ in links) and r.kept == (i == low[i]) for i, r in got.items())
    assert near_vectors(frame.limit(0)).collect() == []
