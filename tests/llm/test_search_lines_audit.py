"""Lexical search, line dedup and the filter audit against SQL and brute force, with odd rows, hot groups and restarts."""
import math
import re
import tempfile
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm_rows import same
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, lexical_search, line_dedup
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _frame(docs, *cols):
    return docs.select("doc_id", "text", *cols).toPandas().astype(object).where(lambda x: x.notna(), None)


# ------------------------------------------------------------ lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _ranked(docs, items, k):
    """Every document scored for every item."""
    held = [(i, Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in _terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_sql(spark):
    same(QUERIES["op11_lexical_search"](spark, SF), lexical_search.ORACLE, documents=f"{SF}/documents.parquet", benchmark=f"{SF}/benchmark.parquet")


@pytest.mark.parametrize("shard, block, wave, share, block_terms", [(3_000, 2, 1, 3, 40), (50_000, 4, 2, 1000, 10**6), (10**9, 8, 3, 1, 10**6)])
def test_search_by_any_cut(spark, documents, monkeypatch, shard, block, wave, share, block_terms):
    """Shards, blocks, waves, what counts as long and the blocks of items change nothing; ties go by doc_id."""
    for name, value in (("SHARD_BYTES", shard), ("BLOCK", block), ("WAVE", wave), ("LONG_SHARE", share)):
        monkeypatch.setattr(lexical_search, name, value)
    copies = documents.union(documents.withColumn("doc_id", F.col("doc_id") + 1000))  # a tie for every document
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").limit(12)
    index = lexical_search.LexicalIndex.build(copies.repartition(3))
    got = _rows(index.search(items, 7, block_terms))
    assert got == _ranked(list(zip(*_frame(copies).values.T)), [tuple(r) for r in items.collect()], 7)


def test_search_skips_blocks(spark):
    """A rare term in one document far ahead: the long list's other blocks are not walked."""
    import pyarrow as pa
    n = 64 * 200
    at, tf = np.arange(n), np.ones(n, np.int64)
    tf[0] = 60
    table = pa.table({"term": pa.array([None, "the"]), "docs": pa.array([at, at]), "tfs": pa.array([np.full(n, 100), tf])})
    lists = lexical_search._Lists(table, n, 100 * n)
    walked = []
    real = np.searchsorted
    try:
        np.searchsorted = lambda a, v: (walked.append(v), real(a, v))[1]
        found, _ = lists.best([("the", 3)], 1)
    finally:
        np.searchsorted = real
    assert found.tolist() == [0] and len(walked) == 1  # the first wave sets the bar that no later block reaches


def test_search_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "Hello WORD line"), (2, None), (None, "general é中😀"), (4, ""), (1, "hello"), (5, "nowhere xyzzy")], "item_id long, text string")
    items = items.withColumns({c: F.lit(1) for c in ("term", "qid", "tf", "rank", "score", "shard")})
    index = lexical_search.LexicalIndex.build(odd.withColumns({c: F.lit(2) for c in ("term", "docs", "tfs", "shard")}))
    assert _rows(index.search(items, 5)) == _ranked(list(zip(*_frame(odd).values.T)), [tuple(r) for r in items.select("item_id", "text").collect()], 5)
    assert index.search(items.where("false"), 5).count() == 0
    none = lexical_search.LexicalIndex.build(empty).search(items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


# ------------------------------------------------------------ line dedup

def _lines(rows, min_docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    docs = Counter(k for _, lines in cut for k in {key(x) for x in lines} if k)
    out = []
    for i, lines in cut:
        kept = [x for x in lines if docs[key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def test_lines_equal_sql(spark, odd):
    same(QUERIES["op12_line_dedup"](spark, SF), line_dedup.ORACLE, documents=f"{SF}/documents.parquet")
    same(line_dedup.line_query(odd), line_dedup.ORACLE, documents=pd.DataFrame(odd.select("doc_id", "text").collect(), columns=["doc_id", "text"]))


@pytest.mark.parametrize("batches, fanout", [(1, 2), (7, 2), (5, 3)])
def test_lines_of_a_hot_key(spark, batches, fanout):
    """A line in a third of all documents, ends and case that differ, keys around the threshold, one very long text."""
    rows = [(i, f"own {i}\n" + ("  The Footer \t" if i % 2 else "the footer") + f"\nshared {i % 40}\n\n\n") for i in range(0, 300, 3)]
    rows += [(i, f"own {i}\n\tshared {i % 41}  ") for i in range(1, 300, 3)] + [(2, "the footer\n" * 4000), (2, "\n"), (None, "THE FOOTER"), (None, "THE FOOTER")]
    rows += [(10_000 + i, "ten\r\nnine" if i < 9 else "ten") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = _got(line_dedup.drop_frequent_lines(df, batches=batches, fanout=fanout))
    assert got == _lines(rows, 10)
    assert (10_009, "", 1, 1) in got and (10_000, "nine", 2, 1) in got  # ten documents reach the threshold, nine do not


def test_line_runs_settle_compact_and_replay(spark):
    """Settled keys are anti-joined away, a replayed batch counts once, and few runs stay live."""
    store = line_dedup.LineRuns(spark, f"{tempfile.mkdtemp()}/store", min_docs=3, fanout=2)
    for b in range(6):
        docs = spark.createDataFrame([(b * 10 + i, f"often\nonce {b} {i}") for i in range(4)], "doc_id long, text string")
        hashed = line_dedup.line_hashes(docs)
        assert store.add(hashed, b)
        assert not store.add(hashed, b)
    live = store.runs.live()
    assert [r.level for r in live] == [2, 1]
    assert store.runs.rows_of(live).where("docs >= 3").count() == 1  # the settled key was never added again
    assert [r.docs for r in store.frequent().collect()] == [4]
    assert store.runs.read().count() == 25


def test_lines_of_odd_rows(odd, empty):
    rows = list(zip(*_frame(odd).values.T))
    for least in (1, 3):
        assert _got(line_dedup.drop_frequent_lines(odd, min_docs=least)) == _lines(rows, least)
    assert line_dedup.drop_frequent_lines(empty).count() == 0
    assert line_dedup.line_query(empty).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_lines_stay_on_the_jvm(spark):
    plan = QUERIES["op12_line_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------ filter audit

def test_audit_equals_sql(spark):
    same(QUERIES["op13_filter_audit"](spark, SF), filter_audit.ORACLE, documents=f"{SF}/documents.parquet", labels=f"{SF}/labels.parquet")


def test_audit_of_odd_rows(spark, odd, empty):
    """Null and repeated ids, null parts and texts, several labels a document, clashing names."""
    labels = spark.createDataFrame([(1, 1, None), (6, 0, 1), (6, 1, 0), (11, 1, 1), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    docs = odd.withColumns({c: F.lit(3) for c in ("part", "mask", "h1", "h2", "first", "good", "toxic")})
    pdf = pd.DataFrame(odd.select("doc_id", "text", "lang").collect(), columns=["doc_id", "text", "lang"])
    got = filter_audit.audit(docs, labels.withColumn("text", F.lit(1)))
    same(got, filter_audit.ORACLE, documents=pdf, labels=pd.DataFrame(labels.collect(), columns=labels.columns))
    assert got.where("part = ''").count() == 600 and got.groupBy("part").count().where("count <> 600").count() == 0
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(odd, labels.where("false")).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_marks_every_later_copy(spark):
    """One text in a third of the rows: all but the least id fail, and the semi-join makes no pairs."""
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    failed = filter_audit.failures(df, {"A": lambda t: t == "nothing"})
    assert {r.mask: r.n for r in failed.groupBy("mask").agg(F.sum("n").alias("n")).collect()} == {0: 2001, 2: 999}
    assert failed.where("mask = 0 and doc_id % 3 = 0").collect()[0].doc_id == 0


def test_interactions_by_brute_force(spark):
    """Three filters, all orders, against a walk over single rows."""
    import itertools
    rng = np.random.default_rng(5)
    rows = [("p", int(rng.integers(8)), 1, int(rng.integers(2)), int(rng.integers(2))) for _ in range(200)]
    counts = spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    got = {(r.filter_order, r.step): r for r in filter_audit.interactions(counts, "XYZ").collect()}
    assert len(got) == 18
    removed_by = Counter()
    for order in itertools.permutations("XYZ"):
        left = rows
        for step, name in enumerate(order, 1):
            bit = 1 << "XYZ".index(name)
            r = got["".join(order), step]
            gone = [x for x in left if x[1] & bit]
            assert r.removed == len(gone) and r.good_lost == sum(x[3] for x in gone) and r.toxic_lost == sum(x[4] for x in gone)
            assert r.redundant == sum(bool(x[1] & bit) for x in rows) - len(gone) and r.unique_fails == sum(x[1] == bit for x in rows)
            left = [x for x in left if not x[1] & bit]
            assert r.kept == len(left)
            removed_by[name] += len(gone)
    assert all(r.shapley == removed_by[r.filter_order[r.step - 1]] for r in got.values())
    with pytest.raises(ValueError):
        filter_audit.interactions(counts, "AA")
