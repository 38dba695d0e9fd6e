"""Line dedup: levelled sorted runs of line hashes that each batch of documents is merged against.

The key of a line is the line without separators at its ends, A-Z
lower-cased; its hash has 128 bits (two XXH64 with different beginnings). The
store (``LineRuns``) is a table of (hash, documents that hold the key) kept as
levelled runs, each sorted by hash. A batch of documents merge-anti-joins the
keys that some run has already settled (found in enough documents),
counts the rest, and adds those as a run of its own; full levels are merged
into one sorted run of the next. Counts only grow, so a settled key needs no
further counting, and a key's documents are the sum over the runs.

Every row counts as a document. All of it is DataFrame code: no Python runs
over lines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_text
from tidemark.session import checkpoint_dir
from tidemark.sinks.runs import Runs

#: What is stripped at the ends of a line, and the letters that are lower-cased.
ENDS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents that make a key too frequent, and the fewest code points of such a key.
MIN_DOCS, MIN_CHARS = 10, 1
#: Batches that the query deals its documents into, and the runs of a level that are merged.
BATCHES, FANOUT = 4, 2
HASH = ["h1", "h2"]
HASHES_SCHEMA = "doc_id long, t1 long, t2 long, keys array<struct<h1: long, h2: long>>, batch int"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(ENDS)), UPPER, LOWER)


def key_hash(key: Column, min_chars: int = MIN_CHARS) -> Column:
    """Both hashes of a key; null for keys that are too short to be dropped."""
    return F.when(F.char_length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


def line_hashes(docs: DataFrame, batches: int = 1, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t1, t2, batch, keys): a document's id, its text's two hashes, and the hash of each of its lines.

    Null text is one empty line. Documents are dealt to batches by id and
    text; equal rows go to the same batch.
    """
    text = F.coalesce("text", F.lit(""))
    rows = id_text(docs).withColumns({"t1": F.xxhash64(text), "t2": F.xxhash64(F.lit(1), text)})
    return rows.select("doc_id", "t1", "t2", F.pmod(F.xxhash64("doc_id", "t1"), F.lit(batches)).cast("int").alias("batch"),
                       F.transform(F.split(text, "\n", -1), lambda x: key_hash(line_key(x), min_chars)).alias("keys"))


class LineRuns:
    """How many documents hold each line key, as levelled sorted runs at ``path``.

    ``add`` takes batches in ascending order of their number; a batch that
    was added before is skipped, so a restarted job goes on where it stopped.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.min_docs = min_docs
        self.runs = Runs(spark, path, lambda rows: rows.groupBy(*HASH).agg(F.sum("docs").alias("docs")), HASH, fanout)

    def add(self, hashed: DataFrame, batch: int) -> bool:
        """Merge-anti-join a batch (rows of ``line_hashes``) with the settled keys, count the rest, add the run."""
        keys = hashed.select(F.explode(F.array_distinct("keys")).alias("k")).where("k is not null")
        counts = keys.groupBy("k.h1", "k.h2").agg(F.count("*").alias("docs"))
        live = self.runs.live()
        if live:
            settled = self.runs.rows_of(live).where(F.col("docs") >= self.min_docs).select(*HASH)
            counts = counts.join(settled.hint("merge"), HASH, "left_anti")
        return self.runs.add(counts, batch)

    def frequent(self) -> DataFrame:
        """(h1, h2, docs) of keys found in at least ``min_docs`` documents (``docs`` counts up to the batch that settled the key, at least)."""
        return self.runs.read().where(F.col("docs") >= self.min_docs)


def dropped_places(hashed: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, gone): the places (from 0) of the lines whose key is frequent, for documents that have any.

    The lines' side of the join may hold one key in a third of its rows; the
    other side has one row a key, so Spark either broadcasts it (if it
    is as small as the session allows) or splits the lines' side.
    """
    places = hashed.select("doc_id", "t1", "t2", F.posexplode("keys").alias("at", "k")).where("k is not null")
    places = places.select("doc_id", "t1", "t2", "at", "k.h1", "k.h2")
    gone = places.join(frequent.select(*HASH), HASH, "left_semi")
    return gone.groupBy("doc_id", "t1", "t2").agg(F.collect_set("at").alias("gone"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines at the places in ``gone``."""
    text = F.coalesce("text", F.lit(""))
    left = id_text(docs).select("doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    right = gone.select(F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "gone")
    on = left["doc_id"].eqNullSafe(right["_id"]) & (left["t1"] == right["_t1"]) & (left["t2"] == right["_t2"])
    rows = left.join(right, on, "left").withColumn("lines", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    joined = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return rows.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(joined).alias("text"),
                       F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                        fanout: int = FANOUT, path: str | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every document, without the lines whose key stands in ``min_docs`` documents or more.

    Null and empty texts are one empty line, which has no key and stays. Rows
    that repeat an id or a whole row are documents of their own, and so are
    rows without an id. Other columns of ``docs`` are left out. An empty
    table gives an empty result. The line hashes and the
    runs are written below ``path`` (by default a new folder in the
    shared checkpoint folder).
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    line_hashes(docs, batches, min_chars).write.partitionBy("batch").parquet(f"{path}/hashes")
    hashed = spark.read.schema(HASHES_SCHEMA).parquet(f"{path}/hashes")
    store = LineRuns(spark, f"{path}/store", min_docs, fanout)
    for batch in range(batches):
        store.add(hashed.where(F.col("batch") == batch), batch)
    store.frequent().select(*HASH).write.mode("overwrite").parquet(f"{path}/frequent")
    return without(docs, dropped_places(hashed, spark.read.parquet(f"{path}/frequent")))


def line_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    return drop_frequent_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  l AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
  k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
  m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key)),
  g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN g USING (r)"""
