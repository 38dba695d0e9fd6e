"""Ranked lexical search: accumulators of short lists beside block-skipping iterators of long ones.

``build`` writes an inverted index in one pass: documents are cut into shards
of about ``SHARD_BYTES`` of text, and a row is one term's postings in one
shard (ordinals and occurrences), so no term's list is ever in one piece. A
search takes the items in blocks of a bounded number of terms. For each shard
and item the lists of rare terms are summed term at a time into one sorted
accumulator list. That list and the long lists are then walked document at a
time: each has a greatest contribution per block of documents, and
blocks whose bounds add up to less than the item's k-th best score are skipped
without touching a posting. Each shard hands on its k best documents of an
item; a ranked window (which keeps k rows a task before its shuffle) merges them.

All arithmetic after a term's weight is in 64-bit integers, so results do not
depend on the cut into shards.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, id_text, text_bytes
from tidemark.session import checkpoint_dir

#: Text of a shard, about; a longer text is a shard of its own.
SHARD_BYTES = 16_000_000
#: Documents of a block, and blocks that are walked before the k-th best score is looked at again.
BLOCK, WAVE = 64, 16
#: A list is long if it has more than one in so many of the shard's documents.
LONG_SHARE = 8
#: Distinct terms of the items that one block of a search holds, about (an item is never cut).
BLOCK_TERMS = 200_000
INDEX_SCHEMA = "shard long, term string, docs array<long>, tfs array<int>"

#: Bytes to bytes: A-Z to a-z, other ASCII that is no letter or digit to a space; the rest belongs to terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(texts: list[bytes | None]) -> tuple[np.ndarray, pa.Array]:
    """The terms of texts as (their number per text, all terms in order)."""
    folded = pa.array([(x or b"").translate(_FOLD) for x in texts], pa.large_binary())
    cut = pc.split_pattern(folded, pattern=b" ")
    values, lens = cut.flatten(), np.asarray(pc.list_value_length(cut), np.int64)
    real = np.asarray(pc.binary_length(values)) > 0
    ends = np.cumsum(lens)
    before = np.concatenate([[0], np.cumsum(real)])
    return before[ends] - before[ends - lens], values.filter(pa.array(real))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to rows of the index: for each shard its documents (term null), then a row a term."""
    shard = TaskContext.get().partitionId() << 32
    for part in chunks(batches, SHARD_BYTES):
        n_terms, values = terms(text_bytes(part))
        has = n_terms > 0
        n = int(has.sum())
        if not n:
            continue
        coded = values.dictionary_encode()
        doc = np.repeat(np.arange(n), n_terms[has])
        code, tf = np.unique(np.asarray(coded.indices, np.int64) * n + doc, return_counts=True)
        term, ordinal = code // n, code % n
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        offsets = np.concatenate([[0, n], n + np.append(starts[1:], len(term))]).astype(np.int32)
        ids = part.column(part.schema.get_field_index("doc_id")).filter(pa.array(has))
        docs = pa.concat_arrays([ids.cast(pa.int64()), pa.array(ordinal, pa.int64())])
        tfs = np.concatenate([n_terms[has], tf]).astype(np.int32)
        names = pa.concat_arrays([pa.nulls(1, pa.string()), coded.dictionary.cast(pa.large_string()).cast(pa.string()).take(pa.array(term[starts]))])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(names), shard), pa.int64()), names, pa.ListArray.from_arrays(pa.array(offsets), docs),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(tfs))], names=["shard", "term", "docs", "tfs"])
        shard += 1


class _Lists:
    """The postings of a shard with their contributions, and each list's greatest contribution per block."""

    def __init__(self, shard: pa.Table, n_docs: int, n_terms: int):
        names, docs, tfs = (shard.column(c).to_pylist() if c == "term" else shard.column(c).combine_chunks() for c in ("term", "docs", "tfs"))
        own = names.index(None)
        self.ids = docs[own].values
        lens = tfs[own].values.to_numpy().astype(np.int64)
        self.n = len(lens)
        m = 75 + (25 * lens * n_docs) // n_terms
        self.blocks = -(-self.n // BLOCK)
        self.lists: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for i, name in enumerate(names):
            if name is not None:
                at, tf = docs[i].values.to_numpy(), tfs[i].values.to_numpy().astype(np.int64)
                gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[at])
                self.lists[name] = (at, gain, self._block_max(at, gain))

    def _block_max(self, at: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Greatest value in each block of documents; ``at`` ascends."""
        most = np.zeros(self.blocks, np.int64)
        block = at // BLOCK
        heads = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(at) else []
        if len(heads):
            most[block[heads]] = np.maximum.reduceat(gain, heads)
        return most

    def accumulators(self, short: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the summed scores of the documents in any of the short lists, ascending."""
        if not short:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([self.lists[t][0] for t, _ in short])
        score = np.concatenate([self.lists[t][1] * w for t, w in short])
        order = np.argsort(at, kind="stable")
        at, score = at[order], score[order]
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        return at[heads], np.add.reduceat(score, heads)

    def best(self, query: list[tuple[str, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ordinals, scores) of the k best documents of a query of (term, weight times occurrences), ties included."""
        query = [(t, w) for t, w in query if t in self.lists and w > 0]
        is_long = [len(self.lists[t][0]) * LONG_SHARE > self.n for t, _ in query]
        at, score = self.accumulators([q for q, x in zip(query, is_long) if not x])
        iterators = [(at, score, self._block_max(at, score))] if len(at) else []
        iterators += [(a, g * w, b * w) for (a, g, b), w in ((self.lists[t], w) for (t, w), x in zip(query, is_long) if x)]
        found, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        if not iterators:
            return found, scores
        bound = sum(b for _, _, b in iterators)
        block = 0
        while True:
            left = np.flatnonzero(bound[block:] >= least)[:WAVE]
            if not len(left):
                return found, scores
            left = left + block
            block = int(left[-1]) + 1
            low, high = int(left[0]) * BLOCK, block * BLOCK
            total = np.zeros(high - low, np.int64)
            walked = np.zeros(block - int(left[0]), bool)
            walked[left - left[0]] = True
            for a, g, _ in iterators:
                i, j = np.searchsorted(a, (low, high))
                inside = walked[(a[i:j] - low) // BLOCK]
                total[a[i:j][inside] - low] += g[i:j][inside]
            good = np.flatnonzero(total >= least)
            found, scores = np.concatenate([found, good + low]), np.concatenate([scores, total[good]])
            if len(scores) > k:
                least = max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                keep = scores >= least
                found, scores = found[keep], scores[keep]


def _search(queries: list[tuple[int, list[tuple[str, int]]]], n_docs: int, n_terms: int, k: int):
    def run(shard: pa.Table) -> pa.Table:
        lists = _Lists(shard, n_docs, n_terms)
        ids = np.asarray(lists.ids.fill_null(np.iinfo(np.int64).max)), np.asarray(lists.ids.is_null())
        qids, docs, scores = [], [], []
        for qid, query in queries:
            found, score = lists.best(query, k)
            first = np.lexsort((ids[0][found], ids[1][found], -score))[:k]
            qids.append(np.full(len(first), qid))
            docs.append(found[first])
            scores.append(score[first])
        return pa.table({"qid": pa.array(np.concatenate(qids), pa.int64()), "doc_id": lists.ids.take(pa.array(np.concatenate(docs))),
                         "score": pa.array(np.concatenate(scores), pa.int64())})
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) of items to (qid, item_id, term, tf)."""
    qid = TaskContext.get().partitionId() << 32
    for part in batches:
        n_terms, values = terms(text_bytes(part))
        rows, ids = np.repeat(np.arange(part.num_rows), n_terms), part.column(0)
        found = pa.table({"row": rows, "term": values}).group_by(["row", "term"]).aggregate([([], "count_all")])
        yield pa.RecordBatch.from_arrays([
            pc.add(found["row"], qid).combine_chunks(), ids.take(found["row"].combine_chunks()), found["term"].combine_chunks().cast(pa.large_string()).cast(pa.string()),
            found["count_all"].combine_chunks().cast(pa.int64())], names=["qid", "item_id", "term", "tf"])
        qid += part.num_rows


class LexicalIndex:
    """An inverted index of documents below ``path``, as ``build`` writes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None) -> LexicalIndex:
        """Index all (doc_id, text) rows; by default in a new folder of the shared checkpoint folder.

        Null and empty texts have no term and are not counted. Rows that
        repeat an id are documents of their own; a null id comes last among ties.
        """
        spark = docs.sparkSession
        path = path or f"{checkpoint_dir(spark)}/lexical-{uuid.uuid4().hex}"
        id_text(docs).mapInArrow(_postings, INDEX_SCHEMA).write.parquet(f"{path}/index")
        return cls(spark, path)

    def size(self) -> tuple[int, int]:
        """(documents with a term, their terms with repeats)."""
        lens = F.aggregate("tfs", F.lit(0).cast("long"), lambda s, x: s + x)
        n, total = self.rows.where("term is null").agg(F.sum(F.size("docs")), F.sum(lens)).first()
        return n or 0, total or 0

    def search(self, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
        """(item_id, rank, doc_id, score): the k best documents of each (item_id, text) row, by score, then doc_id.

        Only scores above 0 count. Items without a term, or with none that
        occurs, have no row; rows that repeat an item_id are ranked each
        for itself. Each block of items reads its own terms' postings.
        """
        n_docs, n_terms = self.size()
        folder = f"{self.path}/items-{uuid.uuid4().hex}"
        named = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        named.mapInArrow(_item_terms, "qid long, item_id long, term string, tf long").write.parquet(folder)
        asked = self.spark.read.schema("qid long, item_id long, term string, tf long").parquet(folder)
        blocks = max(1, -(-asked.count() // block_terms))
        found = None
        for block in range(blocks if n_docs else 0):
            own = asked.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block)
            wanted = F.broadcast(own.select("term").distinct())  # a block's terms
            lists = self.rows.join(wanted, "term", "left_semi")
            df = lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
            weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
            weighted = own.join(df, "term").groupBy("qid").agg(F.collect_list(F.struct("term", (weight * F.col("tf")).alias("w"))).alias("q"))
            queries = [(r["qid"], [(x["term"], x["w"]) for x in r["q"]]) for r in weighted.collect()]  # of one block
            if not queries:
                continue
            shards = lists.unionByName(self.rows.where("term is null")).groupBy("shard")
            best = shards.applyInArrow(_search(queries, n_docs, n_terms, k), "qid long, doc_id long, score long")
            found = best if found is None else found.unionByName(best)
        if found is None:
            return self.spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
        order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.join(asked.select("qid", "item_id").distinct(), "qid").select("item_id", "rank", "doc_id", "score")


def search_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the 20 best documents of each benchmark item."""
    return LexicalIndex.build(docs).search(items, 20)


ORACLE = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term),
  t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, up, low), term)) AS term
        FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents), fold),
  p AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
  n AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
  s AS (SELECT count(*) AS holding, sum(n)::BIGINT AS held FROM n),
  f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
  w AS (SELECT term, CAST(floor(1000 * ln((2 * holding + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM f, s),
  q AS (SELECT i, item_id, unnest(regexp_extract_all(translate(text, up, low), term)) AS term
        FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark), fold),
  g AS (SELECT i, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * holding) // held))))::BIGINT AS score
        FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (r), s GROUP BY ALL),
  o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM g WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20"""
