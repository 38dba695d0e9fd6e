"""Substring, SimHash and embedding duplicates against brute force."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import embedding_dedup, simhash
from tidemark.llm import substring_dedup as sub
from tidemark.llm.components import components


def repeats(rows, length=20):
    """Per row: words, removed words, digest of the kept ones."""
    order = lambda i: i if i is not None else sub.NO_ID
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        w = (t or "").encode().split()
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s:s + length]), (order(i), s))
            first[tuple(w[s:s + length])] = min(first[tuple(w[s:s + length])], (order(i), s))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] < (order(i), s):
                gone[s:s + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in sub.substring_query(df).collect()), key=repr)


def passages():
    rnd = random.Random(1)
    v = [f"w{k}" for k in range(300)]
    base = [[rnd.choice(v) for _ in range(200)] for _ in range(8)]
    common = [rnd.choice(v) for _ in range(35)]
    rows = []
    for i in range(150):
        b = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 4)):
            b[rnd.randrange(len(b))] = rnd.choice(v)
        a = rnd.randint(0, 100)
        rows.append((i, " ".join([rnd.choice(v) for _ in range(rnd.randint(0, 30))] + (common if i % 2 else []) + b[a:a + rnd.randint(0, 100)])))
    for i in range(200, 280):
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(rnd.choice("ab" if i % 3 else "a") for _ in range(rnd.randint(0, 120)))))
    return rows + [(1000, None), (1001, "x " * 300), (1002, "x " * 500 + "y"), (1003, "a b c " * 200), (1004, ""), (-5, "x " * 25)]


@pytest.mark.parametrize("blocks", [1000, 3])
def test_substrings(spark, monkeypatch, blocks):
    """Also with every shard overfull, so that hot anchors are cut into windows."""
    monkeypatch.setattr(sub, "SHARD_BLOCKS", blocks)
    rows = passages()
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == repeats(rows)


def test_substrings_of_the_greatest_id(spark):
    """It stays an id beside rows that have none."""
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(1, line), (2**63 - 1, f"a {line} b"), (None, f"c {line}"), (2**63 - 1, line), (None, line), (None, None)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == repeats(rows)


def test_window_hashes_that_clash_are_told_apart(monkeypatch):
    """Single windows of overfull anchors carry their anchor beside the hash."""
    runs = sub.Windows.runs
    monkeypatch.setattr(sub.Windows, "runs", lambda self, starts, size: np.full(len(starts), 7, np.uint64) if np.ndim(size) == 0 and size == sub.LENGTH else runs(self, starts, size))
    words = [f"w{i}" for i in range(60)]
    text = b" ".join(w.encode() for w in words)
    blocks = [{"start": 0, "n": 1, "anchor": 11, "full": True}, {"start": 40, "n": 1, "anchor": 12, "full": True}]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("full", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0], pa.int32()), pa.array([text.decode()]), pa.array([blocks], kind)], names=["id", "ver", "text", "blocks"])
    (out,) = sub.block_words(iter([batch]))
    assert out.to_pydict() | {"words": None} == {"key": [7, 7], "anchor": [11, 12], "id": [1, 1], "ver": [0, 0], "start": [0, 40], "words": None}


def test_substrings_of_documents(documents):
    assert got(documents) == repeats([(r.doc_id, r.text) for r in documents.collect()])


def test_substrings_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == repeats(rows)
    assert sub.substring_query(empty).count() == 0


def test_automaton_finds_first_places():
    rnd = random.Random(2)
    for _ in range(50):
        s = [rnd.randrange(3) for _ in range(60)]
        a = sub.Automaton()
        for c in s:
            a.add(c)
        t = [rnd.randrange(3) for _ in range(40)]
        found = dict(a.earlier(t, 4))
        for i in range(len(t)):
            at = [k for k in range(3, len(s)) if i >= 3 and s[k - 3:k + 1] == t[i - 3:i + 1]]
            assert found.get(i) == (min(at) if at else None)


def plain_fingerprint(text, k=4):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(items, near):
    """Component (least item) of each item by brute force."""
    part = list(range(len(items)))

    def top(i):
        while part[i] != i:
            part[i] = part[part[i]]
            i = part[i]
        return i

    for i in range(len(items)):
        for j in np.flatnonzero(near(i)):
            part[top(max(i, int(j)))] = top(min(i, int(j))) if top(i) != top(int(j)) else part[top(max(i, int(j)))]
            a, b = top(i), top(int(j))
            part[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(items))]


def check_groups(df):
    rows = [r for r in df.select("doc_id", "text").collect()]
    fps = np.array([plain_fingerprint(r.text) for r in rows], np.uint64)
    part = linked(rows, lambda i: np.bitwise_count(fps ^ fps[i]) <= 4)
    least = {}
    for r, p in zip(rows, part):
        if r.doc_id is not None:
            least[p] = min(least.get(p, r.doc_id), r.doc_id)
    exp = sorted(((r.doc_id, format(int(f), "016x"), least.get(p)) for r, f, p in zip(rows, fps, part)), key=repr)
    assert sorted((tuple(r) for r in simhash.simhash_groups(df).collect()), key=repr) == exp


def test_simhash_of_documents(documents):
    check_groups(documents)


def test_simhash_near_copies_and_odd_rows(spark, odd, empty):
    rnd = random.Random(4)
    v = [f"w{k}" for k in range(500)]
    rows = []
    for b in range(4):
        base = [rnd.choice(v) for _ in range(250)]
        for _ in range(60):  # groups large enough for the walk
            copy = list(base)
            copy[rnd.randrange(250)] = rnd.choice(v)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    check_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    check_groups(odd.where("doc_id <> 5 or doc_id is null"))
    assert simhash.simhash_groups(empty).count() == 0


def test_large_groups_walk_like_pairs():
    rnd = np.random.default_rng(1)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rnd.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 60).astype(np.uint64))
                                    for c in rnd.integers(0, 2**63, 5).astype(np.uint64)]))
    part = linked(list(fps), lambda i: np.bitwise_count(fps ^ fps[i]) <= 4)
    own = {int(f): int(f) for f in fps.view(np.int64)}

    def top(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in simhash.forest(fps.view(np.int64), 4):
        own[top(a)] = top(b)
    groups = {}
    for f, p in zip(fps.view(np.int64).tolist(), part):
        groups.setdefault(p, set()).add(top(f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_large_keys_are_dealt_anew(spark, monkeypatch):
    """A key of very many fingerprints loses no link when its rows go on by further pieces, also where it runs over batches."""
    monkeypatch.setattr(simhash, "LARGE_GROUP", 40)
    rnd = np.random.default_rng(5)
    hot = (rnd.integers(0, 2**63, 1200).astype(np.uint64) & ~np.uint64(2**21 - 1)) | np.uint64(12345)  # one segment is equal
    near = hot[:300].copy()
    for _ in range(4):
        near ^= np.uint64(1) << rnd.integers(0, 64, 300).astype(np.uint64)
    dense = hot[0] ^ (np.uint64(1) << rnd.integers(0, 64, 90).astype(np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 90).astype(np.uint64))
    fps = np.unique(np.concatenate([hot, near, dense]))
    part = linked(list(fps), lambda i: np.bitwise_count(fps ^ fps[i]) <= 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        links = simhash.near_fingerprints(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(3))
        pairs = [(r.a, r.b) for r in links.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all((a ^ b).bit_count() <= 4 or ((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in pairs)
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    classes = {}
    for f, p in zip(fps.view(np.int64).tolist(), part):
        classes.setdefault(p, set()).add(found.get(f, f))
    assert all(len(c) == 1 for c in classes.values()) and len(set.union(*classes.values())) == len(classes)


def test_one_of_each_keeps_one(odd):
    kept = simhash.one_of_each(odd, simhash.simhash_groups(odd)).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 1 in ids and 6 not in ids and 2 in ids and 3 not in ids  # 2, 3 and 4 have no words
    assert sum(r.doc_id is None for r in kept) == 2 and kept[0].__fields__ == odd.columns


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(7, 7), (9, 8)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 141)) and all(found[k] == 500 for k in range(500, 560)) and found[9] == found[8] == 8
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def clusters(spark, n=1500, dim=32):
    rnd = np.random.default_rng(7)
    x = rnd.standard_normal((n, dim))
    for i in range(0, 300, 3):
        x[i + 1] = x[i] + 0.25 * rnd.standard_normal(dim)
        x[i + 2] = x[i + 1] + 0.25 * rnd.standard_normal(dim)
    x[400:900] = x[400] + 0.2 * rnd.standard_normal((500, dim))  # a dense group, larger than a leaf
    x[1000:1200] = x[1000]
    return x.astype(np.float32)


def test_embeddings(spark):
    x = clusters(spark)
    df = spark.createDataFrame([(i * 3, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    rows = {r.vec_id: r for r in embedding_dedup.embedding_groups(df).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    true, found = near.sum(1), np.array([rows[i * 3].n_links for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    part = linked(list(range(len(x))), lambda i: near[i])
    right = sum(rows[i * 3].component_id == p * 3 for i, p in enumerate(part))
    assert right >= 0.97 * len(x) and all(r.kept == (r.vec_id == r.component_id) for r in rows.values())


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []),
            (9, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as mult", "3 as v")
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_groups(df).collect()), key=repr)
    exp = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)], (None, 0, None, False)]
    assert out == sorted(exp, key=repr)
    assert embedding_dedup.embedding_groups(df.where("false")).count() == 0

@pytest.mark.parametrize("others", [500, 2_500])
def test_embeddings_hot_group(spark, others):
    """A group of distinct near-copies well above BUCKET loses next to none of its links, alone or among others."""
    rng = np.random.default_rng(8)
    hot = rng.standard_normal(32) + 0.22 * rng.standard_normal((6_000, 32))
    x = np.concatenate([hot, rng.standard_normal((others, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    rows = {r.vec_id: r for r in embedding_dedup.embedding_groups(df).collect()}
    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    true = ((y @ y.T) >= embedding_dedup.THRESHOLD).sum(axis=1) - 1
    got = np.array([rows[i].n_links for i in range(len(x))])
    print("recall", got.sum() / true.sum(), got.sum(), true.sum())
    assert true.sum() > 10_000_000 and (got <= true).all() and got.sum() >= 0.97 * true.sum()
    assert len({rows[i].component_id for i in range(6_000) if true[i]}) == 1
