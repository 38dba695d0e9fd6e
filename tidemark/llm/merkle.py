"""Document fingerprints: a Merkle tree over paragraphs and sections, in SQL functions only.

A paragraph is a line, or a sentence or piece of at most 48 characters of
one. A section is a run of paragraphs that closes where a paragraph's hash says so
(one in eight), so an edit moves no section boundary but its own. A
section's node hashes its paragraphs' nodes, the root those of the sections:
equal roots mean equal texts, and below differing roots only differing
sections, then differing paragraphs, need a look.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text
from tidemark.operators import ordered

PARAGRAPH = r"[^\n.!?]{1,48}[\n.!?]{0,200}|[\n.!?]{1,200}"
#: A paragraph closes its section if its hash begins with one of these.
CLOSING = ("0", "8")
#: Consecutive documents that share a group, about, and the most groups (the broadcast table of group ends has as many rows).
DOCS_PER_GROUP, MAX_GROUPS = 250, 50_000


def paragraphs(text: Column) -> Column:
    """Hashes of a text's paragraphs, in order (null and empty text: none)."""
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.transform(cut, lambda p: F.substring(F.md5(p.cast("binary")), 1, 16))


def with_tree(df: DataFrame, text_col: str, prefix: str) -> DataFrame:
    """Adds ``{prefix}paragraphs``, ``{prefix}sections`` (arrays of nodes), ``{prefix}ends`` (each section's last paragraph, from 1) and ``{prefix}root``."""
    par, end, sec = f"{prefix}paragraphs", f"{prefix}ends", f"{prefix}sections"
    df = df.withColumn(par, paragraphs(F.col(text_col)))
    n = F.size(par)
    df = df.withColumn(end, F.when(n == 0, F.array().cast("array<int>")).otherwise(F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i == F.size(par)) | F.substring(F.element_at(par, i), 1, 1).isin(*CLOSING))))

    def section(e: Column, k: Column) -> Column:
        before = F.when(k == 0, 0).otherwise(F.get(end, k - 1))
        return F.md5(F.array_join(F.slice(par, before + 1, e - before), "").cast("binary"))

    df = df.withColumn(sec, F.transform(end, section))
    return df.withColumn(f"{prefix}root", F.md5(F.array_join(sec, "").cast("binary")))


def likeness(a: str, b: str, equal: Column) -> Column:
    """0 to 1 for two trees by prefix: 1 where ``equal``, else twice the shared distinct paragraphs over both counts.

    Only two empty texts have no paragraph, and they are equal.
    """
    shared = F.size(F.array_intersect(f"{a}paragraphs", f"{b}paragraphs"))
    both = F.size(F.array_distinct(f"{a}paragraphs")) + F.size(F.array_distinct(f"{b}paragraphs"))
    return F.when(equal, 1.0).otherwise(2.0 * shared / both)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shared(a: Column, b: Column) -> Column:
    """(before, after) of two differing arrays: how many leading, then trailing elements they share."""
    places = F.sequence(F.lit(1), F.greatest(F.size(a), F.size(b), F.lit(1)))
    before = F.get(F.filter(places, lambda i: ~F.get(a, i - 1).eqNullSafe(F.get(b, i - 1))), F.lit(0)) - 1
    after = F.get(F.filter(places, lambda i: ~F.get(a, F.size(a) - i).eqNullSafe(F.get(b, F.size(b) - i))), F.lit(0)) - 1
    return _let(before, lambda n: F.struct(n.alias("before"), F.least(after, F.least(F.size(a), F.size(b)) - n).alias("after")))


def _inside(a: Column, b: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """``body`` of how many leading elements two differing arrays share and of what lies between the shared ends of each."""
    def cut(x: Column, ends: Column) -> Column:
        return F.slice(x, ends["before"] + 1, F.size(x) - ends["before"] - ends["after"])

    return _let(_shared(a, b), lambda ends: _let(F.struct(ends["before"].alias("n"), cut(a, ends).alias("a"), cut(b, ends).alias("b")),
                                                 lambda s: body(s["n"], s["a"], s["b"])))


def _sections(prefix: str) -> Column:
    """A tree's sections as structs (node, paragraphs)."""
    return _let(F.struct(F.col(f"{prefix}paragraphs").alias("p"), F.col(f"{prefix}sections").alias("s")), lambda t: _let(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(t["p"]), F.lit(1))),
                 lambda i: (i == F.size(t["p"])) | F.substring(F.get(t["p"], i - 1), 1, 1).isin(*CLOSING)),
        lambda ends: F.transform(t["s"], lambda node, k: F.struct(node.alias("node"), F.slice(
            t["p"], F.coalesce(F.get(ends, k - 1), F.lit(0)) + 1, F.get(ends, k) - F.coalesce(F.get(ends, k - 1), F.lit(0))).alias("p")))))


def edits(a: str, b: str) -> Column:
    """Where tree ``a`` differs from ``b``: places (from 1) of paragraphs of ``a``, none below equal roots.

    Sections that both share at their beginning and end are skipped, then such paragraphs. Of those between, the
    places are of each that ``b`` has fewer times up to there. If there is none (paragraphs were moved,
    removed or less often repeated), they are of each that ``b`` has not at the same place; if nothing is
    between, the place that follows the shared beginning, where ``b`` has more.
    """
    def places(n: Column, x: Column, y: Column) -> Column:
        every = F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)))

        def times(of: Column, p: Column) -> Column:
            return F.size(F.filter(of, lambda q: q == p))

        lacking = F.filter(every, lambda i: _let(F.get(x, i - 1), lambda p: times(F.slice(x, F.lit(1), i), p) > times(y, p)))
        moved = F.filter(every, lambda i: ~F.get(x, i - 1).eqNullSafe(F.get(y, i - 1)))
        found = F.when(F.size(x) == 0, F.array(F.lit(1))).otherwise(_let(lacking, lambda at: F.when(F.size(at) > 0, at).otherwise(moved)))
        return F.transform(found, lambda i: (i + n).cast("int"))

    def flat(sections: Column) -> Column:
        return F.flatten(F.transform(sections, lambda s: s["p"]))

    def below(n: Column, x: Column, y: Column) -> Column:
        return _let(F.struct(flat(x).alias("x"), flat(y).alias("y")), lambda s: _inside(
            s["x"], s["y"], lambda more, u, v: places(n + more, u, v)))

    def paragraphs_before(sections: Column, n: Column) -> Column:
        return F.aggregate(F.slice(sections, F.lit(1), n), F.lit(0), lambda total, s: total + F.size(s["p"]))

    differing = _let(F.struct(_sections(a).alias("x"), _sections(b).alias("y")), lambda t: _inside(
        t["x"], t["y"], lambda n, x, y: below(paragraphs_before(t["x"], n), x, y)))
    return F.when(F.col(f"{a}root") == F.col(f"{b}root"), F.array().cast("array<int>")).otherwise(differing)


def first_edit(a: str, b: str) -> Column:
    """Place (from 1) of the first paragraph at which tree ``a`` differs from ``b``, null below equal roots.

    Equal sections at the beginning are passed by their nodes; then only the paragraphs of the first differing
    section are compared (both trees' begin at the same place). Where ``b`` goes on after the end of ``a``, it is the place behind it.
    """
    x, y = F.col(f"{a}sections"), F.col(f"{b}sections")
    differing = F.get(F.filter(F.sequence(F.lit(0), F.size(x)), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i))), F.lit(0))

    def inside(k: Column) -> Column:
        start = F.when(k == 0, F.lit(0)).otherwise(F.get(f"{a}ends", k - 1))
        stop = F.coalesce(F.get(f"{a}ends", k), F.size(f"{a}paragraphs"))
        return F.get(F.filter(F.sequence(start + 1, stop + 1), lambda i: ~F.get(f"{a}paragraphs", i - 1).eqNullSafe(F.get(f"{b}paragraphs", i - 1))), F.lit(0))

    return F.when(F.col(f"{a}root") != F.col(f"{b}root"), _let(differing, inside)).cast("int")


def trees(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, paragraphs, sections, root of every text: the operator's general form.

    Every row stands for itself; null text counts as empty. No shuffle.
    """
    out = with_tree(id_text(docs), "text", "")
    return out.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                      "paragraphs", "sections", "root")


def groups_of(docs: DataFrame) -> Column:
    """The group of neighbouring ids that a row belongs to; rows without an id are a group before all others."""
    groups = max(1, min(docs.count() // DOCS_PER_GROUP, MAX_GROUPS))
    return ordered.buckets(docs.select("doc_id"), ["doc_id"], groups).column.cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """Adds ``next``: the text of the next document by descending doc_id, the last's being the first's.

    Documents go in groups of about 250 neighbours (by counts, so an outlying id
    changes nothing), one shuffle of the texts. The next of a group's last
    document is the greatest of the group below: at most MAX_GROUPS ids, so
    those are broadcast. Rows that share an id or lack one (after all others)
    follow one another by text, in one group.
    """
    docs = id_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    grouped = docs.withColumn("grp", groups_of(docs))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    # the greatest id of each group and, for the group above it (the first group follows the last), that group
    tops = grouped.groupBy("grp").agg(F.max("doc_id").alias("top"))
    by = Window.orderBy(F.col("grp").desc())
    ends = tops.select("top", F.col("grp").alias("own"), F.coalesce(F.lag("grp").over(by), F.last("grp").over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("above"))
    first = grouped.alias("d").join(F.broadcast(ends).alias("e"), (F.col("d.grp") == F.col("e.own")) & F.col("d.doc_id").eqNullSafe(F.col("e.top")))
    first = first.groupBy("above").agg(F.min("text").alias("edge"))  # of rows that share the id, the first by text
    inside = grouped.withColumn("next", F.lead("text").over(Window.partitionBy("grp").orderBy(*order)))
    joined = inside.join(first, inside["grp"] == first["above"], "left")
    return joined.select("doc_id", "text", F.coalesce("next", "edge").alias("next"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of every text, of its edited text, and how near they and the next document's are.

    The edited text is the text with its last half replaced by as much of the
    next document's beginning. ``first_edit`` is the place (from 1) of the
    first paragraph of the edited text that differs from the text's, null if the texts are equal.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    df = df.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                          F.substring("next", F.lit(1), half)))
    for col, prefix in (("text", ""), ("edited", "edited_"), ("next", "next_")):
        df = with_tree(df, col, prefix)
    return df.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     F.col("root").alias("fingerprint"), F.col("edited_root").alias("edited_fingerprint"),
                     likeness("", "edited_", F.col("root") == F.col("edited_root")).alias("near_edited"),
                     likeness("", "next_", F.col("root") == F.col("next_root")).alias("near_next"),
                     first_edit("edited_", "").alias("first_edit"))


_SQL_TREE = """
  {p}_par AS (SELECT *, list_transform(regexp_extract_all({c}, '[^\\n.!?]{{1,48}}[\\n.!?]{{0,200}}|[\\n.!?]{{1,200}}'),
                     lambda x: substr(md5(x), 1, 16)) AS {p}p FROM {src}),
  {p}_end AS (SELECT *, list_filter(range(1, len({p}p) + 1), lambda i: i = len({p}p) OR substr({p}p[i], 1, 1) IN ('0', '8')) AS {p}e FROM {p}_par),
  {p}_sec AS (SELECT *, list_transform(range(1, len({p}e) + 1), lambda k:
                     md5(array_to_string({p}p[(CASE WHEN k = 1 THEN 0 ELSE {p}e[k - 1] END) + 1:{p}e[k]], ''))) AS {p}s FROM {p}_end),
  {p}_tree AS (SELECT *, md5(array_to_string({p}s, '')) AS {p}root FROM {p}_sec)"""

ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  n AS (SELECT *, CAST(length(text) AS BIGINT) AS n_chars,
               coalesce(lead(text) OVER (ORDER BY doc_id DESC, text), first_value(text) OVER (ORDER BY doc_id DESC, text)) AS nxt FROM d),
  e AS (SELECT *, substr(text, 1, n_chars - n_chars // 2) || substr(nxt, 1, n_chars // 2) AS edited FROM n),""" + ",".join(
    _SQL_TREE.format(p=p, c=c, src=src) for p, c, src in (("t", "text", "e"), ("u", "edited", "t_tree"), ("v", "nxt", "u_tree"))) + """
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, troot AS fingerprint, uroot AS edited_fingerprint,
       CASE WHEN troot = uroot THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(tp, up)) / (len(list_distinct(tp)) + len(list_distinct(up))) END AS near_edited,
       CASE WHEN troot = vroot THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(tp, vp)) / (len(list_distinct(tp)) + len(list_distinct(vp))) END AS near_next,
       CASE WHEN troot = uroot THEN NULL ELSE CAST(list_filter(range(1, len(up) + 2), lambda i: up[i] IS DISTINCT FROM tp[i])[1] AS INTEGER) END AS first_edit
FROM v_tree"""
