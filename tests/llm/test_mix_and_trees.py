"""Source mixing and Merkle trees against SQL, and by their own rules."""
import random

import pytest
from llm_rows import same
from pyspark.sql import functions as F

from tidemark.llm import merkle, mixing


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if most * sizes[s] < level * w[s]}
        if not over:
            out |= {s: level * w[s] for s in free}
            break
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return out


def test_targets(spark):
    rnd = random.Random(2)
    for _ in range(4):
        sizes = {s: rnd.choice([0, 1, 10, 500, 9000]) for s in ["a", "b", "é", "z", "Z", None][:rnd.randint(1, 6)]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(filled(sizes), abs=1e-6)


def test_mix_equals_sql(documents):
    got = mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken")
    same(got, mixing.ORACLE, documents="/root/testdata/sf0.001/documents.parquet")


@pytest.mark.parametrize("rows", [20_000, 7])
def test_mix_rules(spark, monkeypatch, rows):
    """Sources meet their targets to the word, with many small key buckets too; reruns agree."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", rows)
    rnd = random.Random(3)
    docs = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40])), rnd.choice(["hot", "hot", "a", "b", None])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)
    for s in {r.source for r in out}:
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        cut = [r for r in own if r.size and r.taken % r.size]
        assert len(cut) <= 1 and all(0 <= r.taken <= 3 * r.size for r in own)
        assert max(r.taken // r.size for r in own if r.size) - min(r.taken // r.size for r in own if r.size) <= 1  # complete epochs first


def test_key_buckets_are_even_for_any_weights(spark):
    """Most rows of one low weight, some of others: no bucket holds much more than its share."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.lit("hot").alias("source"))
    weight = F.when(F.col("doc_id") % 9 < 7, 0.05).when(F.col("doc_id") % 9 == 7, 0.7).otherwise(1000.0)
    sizes = [r["count"] for r in mixing.with_keys(docs, 200, 1, weight).groupBy("bucket").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 1.4 * 40_000 / 200


def test_mix_odd_rows(odd, empty):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count() and all(r.taken <= 3 * r.size for r in out) and mixing.mix(empty).count() == 0
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    assert all(abs(sum(r.taken for r in own) - own[0].target) <= 2 for own in by.values())  # rows of one id share a cut
    assert {r.taken for r in out if r.doc_id == 2} == {0}


def test_trees_equal_sql(documents):
    same(merkle.fingerprints(documents), merkle.ORACLE, documents="/root/testdata/sf0.001/documents.parquet")


def test_trees_of_few_and_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DOCS_PER_GROUP", 2)
    rows = [(10**15, "One. Two. Three."), (-4, "One. Two. Four."), (7, ""), (8, "é" * 101), (9, "One. Two. Three."), (50, "x\ny\nz")]
    for part in (rows, rows[:1], rows[:2]):
        df = spark.createDataFrame(part, "doc_id long, text string")
        same(merkle.fingerprints(df), merkle.ORACLE, documents=df.toPandas())


def test_roots_and_edits(spark):
    text = "\n".join(f"Paragraph {i} says {i * i}." for i in range(60))
    df = spark.createDataFrame([(1, text, text), (2, text, text.replace("says 900.", "said 900.")), (3, "", "")], "doc_id long, a string, b string")
    t = merkle.with_tree(merkle.with_tree(df, "a", "a_"), "b", "b_")
    rows = {r.doc_id: r for r in t.select("doc_id", (F.col("a_root") == F.col("b_root")).alias("same"), merkle.edits("b_", "a_").alias("at"),
                                          merkle.likeness("a_", "b_", F.col("a_root") == F.col("b_root")).alias("near"), F.size("b_sections").alias("n")).collect()}
    assert rows[1].same and rows[1].at == [] and rows[1].near == 1.0 and rows[3].same and rows[3].near == 1.0
    assert not rows[2].same and 1 <= len(rows[2].at) <= 2 < rows[2].n and 0.9 < rows[2].near < 1.0


def test_edits_by_place(spark):
    """Edits are places of paragraphs, also where they are repeated, moved or removed."""
    lines = [f"Line {i} says {i * i}\n" for i in range(60)]
    swapped = [*lines[:10], lines[40], *lines[11:40], lines[10], *lines[41:]]
    cases = [(["New here\n" if i in (7, 50) else x for i, x in enumerate(lines)], lines, [8, 51]),  # two edits far apart, one text
             (lines[:30] + lines[3:5] + lines[30:], lines, [31, 32]),  # repeated
             (swapped, lines, [11, 41]),  # moved
             (lines[:20] + lines[25:], lines, [21]), (lines[:-1], lines, [60]), ([], lines, [1]),  # removed
             (lines, [], list(range(1, 61))), (lines[:1] * 3, lines[:1] * 2, [3]), (lines, lines, [])]
    df = spark.createDataFrame([(i, "".join(a), "".join(b)) for i, (a, b, _) in enumerate(cases)], "doc_id long, a string, b string")
    t = merkle.with_tree(merkle.with_tree(df, "a", "a_"), "b", "b_").select("doc_id", merkle.edits("a_", "b_").alias("at"))
    got = {r.doc_id: r.at for r in t.collect()}
    assert [got[i] for i in range(len(cases))] == [at for *_, at in cases]


def test_the_first_edit_is_a_paragraph(spark):
    """The first paragraph that differs, whatever the sections: changed, moved, repeated, removed, put in front or behind."""
    lines = [f"Line {i} says {i * i}\n" for i in range(60)]
    cases = [(lines[:33] + ["New\n"] + lines[34:], lines), (lines[:10] + lines[11:12] + lines[10:11] + lines[12:], lines), (lines[:5] + lines[4:], lines),
             (lines[:20] + lines[25:], lines), (lines[:-1], lines), (lines + ["More\n"], lines), (["New\n"] + lines, lines), ([], lines), (lines, []), (lines, lines)]
    want = [next((i + 1 for i in range(max(len(a), len(b))) if a[i:i + 1] != b[i:i + 1]), None) for a, b in cases]
    df = spark.createDataFrame([(i, "".join(a), "".join(b)) for i, (a, b) in enumerate(cases)], "doc_id long, a string, b string")
    got = dict(merkle.with_tree(merkle.with_tree(df, "a", "a_"), "b", "b_").select("doc_id", merkle.first_edit("a_", "b_")).collect())
    assert [got[i] for i in range(len(cases))] == want


def test_groups_of_neighbours_are_even_with_an_outlying_id(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DOCS_PER_GROUP", 50)
    df = spark.range(2_000).union(spark.createDataFrame([(10**15,)], "id long")).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    by = merkle.groups_of(df)
    sizes = [r["count"] for r in df.groupBy(by.alias("g")).count().collect()]
    assert max(sizes) <= 100 and len(sizes) == 40


def test_trees_odd_rows(odd, empty):
    out = merkle.fingerprints(odd).collect()
    assert len(out) == odd.count() and merkle.fingerprints(empty).count() == 0
    assert len({r.fingerprint for r in out if r.doc_id in (1, 6)}) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert merkle.trees(odd).count() == odd.count()


def test_no_python_in_the_plan(documents):
    plan = merkle.fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Arrow", "Pandas"))
