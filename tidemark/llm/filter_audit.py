"""Filter interaction audit: which filter removes what, in every order of the filters.

Filters on a row's own text are column expressions. The filter against exact
copies is an existential self-join: a left-semi join on hash, exact text and
smaller doc_id marks its rows. The marks and the other failures are united
by id into one bit combination a row; counts of the combinations of each part
(at most 2^k, whatever the table's size) then give every figure of every order.

Texts move once: a first narrow count finds hashes that occur twice, and only
rows with such a hash bring their text along. Each distinct text of those
has one row (its least id) on the other side of the semi-join, so a group of
copies makes no pairs, and Spark can split the side that holds the group.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, n_words
from tidemark.session import checkpoint_dir

Filter = Callable[[Column], Column]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Figures for k filters have k! orders.
MOST_FILTERS = 6
#: Name of the filter against copies.
COPIES = "E"


def few_words(text: Column, least: int = 200) -> Column:
    return n_words(text) < least


def repetitive(text: Column, least_percent: int = 50) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return 100 * F.size(F.array_distinct(words)) < least_percent * F.size(words)


def shouting(text: Column, most_percent: int = 3) -> Column:
    return 100 * (F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))) > most_percent * F.char_length(text)


def symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Filters by name: true where a text (never null) fails.
FILTERS: dict[str, Filter] = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}


def _texts(docs: DataFrame, part: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def copies(texts: DataFrame, hashes: DataFrame, folder: str) -> DataFrame:
    """Rows of ``texts`` (doc_id, part, text, h1, h2) whose text also has a smaller doc_id, without the text.

    ``hashes`` has the same rows' h1 and h2. A row without an id is no smaller
    and no greater than any. Two tables are written below ``folder``.
    """
    spark = texts.sparkSession
    hashes.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2").write.parquet(f"{folder}/twice")
    texts.join(spark.read.parquet(f"{folder}/twice"), ["h1", "h2"], "left_semi").write.parquet(f"{folder}/twins")
    twins = spark.read.parquet(f"{folder}/twins")
    twins.groupBy("h1", "h2", "text").agg(F.min("doc_id").alias("first")).write.parquet(f"{folder}/firsts")
    first = spark.read.parquet(f"{folder}/firsts")
    same = (twins["h1"] == first["h1"]) & (twins["h2"] == first["h2"]) & (twins["text"] == first["text"])
    return twins.join(first, same & (first["first"] < twins["doc_id"]), "left_semi").select("doc_id", "part", "h1", "h2")


def failures(docs: DataFrame, filters: dict[str, Filter] | None = None, part: str = "lang", folder: str | None = None) -> DataFrame:
    """(doc_id, part, mask, n): which filters documents fail, bit i for the i-th name of ``filters`` and the last bit for copies.

    Null text counts as empty, a null part as the empty string. ``n`` is how
    many equal rows (same id, part and text) a row stands for: repeated
    rows count as often as they occur, and are no copies of one another,
    since none has a smaller id. No row is lost; an empty table gives none.
    """
    filters = FILTERS if filters is None else filters
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"
    texts = _texts(docs, part)
    bits = [F.when(fails(F.col("text")), F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(filters.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    texts.select("doc_id", "part", "h1", "h2", mask.cast("int").alias("mask")).write.parquet(f"{folder}/own")
    own = spark.read.parquet(f"{folder}/own")
    marked = copies(texts, own.select("h1", "h2"), folder)
    union = own.withColumn("n", F.lit(1)).unionByName(marked.select("*", F.lit(1 << len(filters)).alias("mask"), F.lit(0).alias("n")))
    return (union.groupBy("doc_id", "part", "h1", "h2").agg(F.bit_or("mask").cast("int").alias("mask"), F.sum("n").alias("n"))
            .select("doc_id", "part", "mask", "n"))


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of each bit combination, and how many of them have quality 1 and toxic 1.

    A document with several labels has quality (or toxic) 1 if any says so.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    known = known.where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = failed.join(known, "doc_id", "left")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def interactions(counts: DataFrame, names: str) -> DataFrame:
    """Every order and step of the filters ``names`` (a letter each, in the order of the mask's bits), per part.

    kept (after the step), removed (at it), redundant (failing its filter,
    removed earlier), unique_fails (failing its filter only), good_lost and
    toxic_lost (removed at it, with that label), shapley (removed by the step's
    filter, summed over all orders, wherever it stands in them).
    """
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"1 to {MOST_FILTERS} different filter names are needed, not {names!r}")
    orders = ",".join("".join(p) for p in itertools.permutations(names))
    rows = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    rows = rows.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    rows = rows.select("*", F.posexplode(F.split("filter_order", "")).alias("place", "name"))

    def bit(name: Column) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, 1 << i)]), name)

    earlier = F.aggregate(F.filter(F.split(F.substring("filter_order", F.lit(1), F.col("place")), ""), lambda x: x != ""),
                          F.lit(0), lambda m, x: m.bitwiseOR(bit(x)))
    rows = rows.withColumns({"own": bit(F.col("name")), "before": earlier})

    def total(where: Callable[[Column], Column], what: str = "n") -> Column:
        return F.aggregate(F.filter("c", lambda x: where(x["mask"])), F.lit(0).cast("long"), lambda s, x: s + x[what])

    own, before = F.col("own"), F.col("before")
    here = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    out = rows.select("part", "filter_order", (F.col("place") + 1).cast("int").alias("step"), "name",
                      total(lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"), total(here).alias("removed"),
                      total(lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
                      total(lambda m: m == own).alias("unique_fails"),
                      total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    each = Window.partitionBy("part", "name")  # a row an order
    return out.withColumn("shapley", F.sum("removed").over(each)).drop("name")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] | None = None, part: str = "lang") -> DataFrame:
    """The interactions of ``filters`` and of the filter against copies over all documents, per part."""
    filters = FILTERS if filters is None else filters
    return interactions(combinations(failures(docs, filters, part), labels), "".join(filters) + COPIES)


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
  w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
               CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS copy FROM d),
  m AS (SELECT part, copy + CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                 + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text) THEN 4 ELSE 0 END
                 + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END AS mask, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
        FROM w LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
                          FROM labels GROUP BY doc_id) l USING (doc_id)),
  f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
  o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM f a, f b, f c, f d, f e
        WHERE length(a.x || b.x || c.x || d.x || e.x) = 5 AND a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
  s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
        FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
  g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
  r AS (SELECT part, filter_order, step, own,
               coalesce(sum(n) FILTER (mask & (own | before) = 0), 0) AS kept,
               coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS removed,
               coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0) AS redundant,
               coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
               coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS toxic_lost
        FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""
