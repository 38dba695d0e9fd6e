"""Randomised checks against small pure-Python models of the reference's semantics."""
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__ as E
from tidemark.functions import udfs
from tidemark.operators import text


def java_split(s: str, sep: str) -> list[str]:
    """java.lang.String#split(literal) with limit 0."""
    parts = re.split(re.escape(sep), s)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_hash(s: str, factor: int = 11) -> int:
    h = 0
    b = s.encode("utf-16-be")
    for i in range(0, len(b), 2):
        h = (h * 31 + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
    v = (h * factor - 10000) & 0xFFFFFFFF
    return v - (1 << 32) if v >= (1 << 31) else v


def test_split_and_hash_match_models(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", "_", " ", "é", "\U0001F600", "\n"]
    cases = [""] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r.i: (r.u, r.sp, r.h) for r in df.select(
        "i", text.jvm_split("s", "_").alias("u"), text.jvm_split("s", " ").alias("sp"),
        udfs.hash_code("s").alias("h")).collect()}
    for i, s in enumerate(cases):
        assert got[i][0] == java_split(s, "_"), s
        assert got[i][1] == java_split(s, " "), s
        assert got[i][2] == java_hash(s), s


def test_no_unkeyed_window_over_rows(spark):
    """A window without a partition key may only run over the per-bucket table (ordered by the bucket id)."""
    seen = 0
    for name in ["watermark_periodic", "late_rows", "max_disorder", "sliding_count_lateness", "window_firings"]:
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Window [" not in line:
                continue
            tail = line[line.rfind(" AS "):]  # "... AS x], [partition], [order]" or "... AS x], [order]"
            if tail.count("], [") == 1:  # no partition key
                assert tail.split("], [")[1].startswith("_b"), line
                seen += 1
    assert seen >= 5  # the prefix over buckets is there, and nothing else is unkeyed


def test_sql_row_frames_split_the_key(spark):
    df = E.queries()["over_rows_sql"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and ("avg(" in line or "count(temp" in line):
            assert "_b" in line[line.rfind(" AS "):], line


def test_checkpoint_folder_comes_from_the_session(spark):
    from tidemark.session import checkpoint_dir
    named = spark.conf.get("spark.checkpoint.dir")
    d = checkpoint_dir(spark)
    assert named.rstrip("/").split("/")[-1] in d  # Spark adds a per-application sub-folder


def _rolled(lines, sep=" "):
    """(id, pos, word, count) by the definition: ids in order (null first), equal ids by position."""
    toks = sorted(((i is not None, i or 0, p), i, w) for i, t in lines if t is not None for p, w in enumerate(java_split(t, sep)) if w)
    seen, out = Counter(), []
    for (_, _, p), i, w in toks:
        seen[w] += 1
        out.append((i, p, w, seen[w]))
    return out


def test_rolling_word_count_moves_lines_and_not_tokens(spark):
    """A token is neither exchanged nor sorted: 60,000 tokens in 300 lines pass the exchanges as lines and counts by bucket."""
    lines = [(i, " ".join(random.Random(i).choices("abcdefgh", k=200))) for i in range(300)]
    df = spark.createDataFrame(lines, "id long, t string").repartition(3)
    got = text.rolling_word_count(df, "t", ["id"])
    assert sorted(map(tuple, got.collect())) == sorted(_rolled(lines))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan, plan  # tokens are made after the last exchange only


@pytest.mark.parametrize("sep", [" ", "ab", "."])
def test_rolling_word_count_of_repeated_null_and_odd_lines(spark, sep):
    rng = random.Random(5)
    ids = [*range(40), None, None, None, *[7] * 30, 2**40]
    lines = [(i, "".join(rng.choices(["x", "y", "é", " ", "a", "b", "ab", ".", "  "], k=rng.randint(0, 40)))) for i in ids]
    lines += [(50, None), (51, ""), (52, " "), (53, "  x  "), (54, "xababab"), (7, None), (None, "x")]
    rng.shuffle(lines)
    df = spark.createDataFrame(lines, "id long, t string").repartition(3)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, text.rolling_word_count(df, "t", ["id"], sep).collect()), key=key) == sorted(_rolled(lines, sep), key=key)


def test_rolling_word_count_keeps_its_counts_between_parts_of_a_bucket(monkeypatch):
    monkeypatch.setattr(text, "HELD_BYTES", 30)
    rows_ = [(0, 1, None, None, "b", 4), (0, 1, None, None, "z", 9)] + [(0, 0, i, 0, "a b  a", None) for i in range(9)] + [(1, 0, 20, 3, "a", None), (2, 1, None, None, "a", 7), (2, 0, 30, 0, "a", None)]
    schema = pa.schema([("_b", pa.int32()), ("_ctx", pa.int32()), ("id", pa.int64()), ("pos", pa.int32()), ("word", pa.string()), ("count", pa.int64())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows_], schema)
    out = [tuple(r.values()) for b in text._counter(["id"], " ", "_b", "_ctx")(iter(table.to_batches(max_chunksize=4))) for r in b.to_pylist()]
    want = [x for i in range(9) for x in ((i, 0, "a", 2 * i + 1), (i, 1, "b", 5 + i), (i, 3, "a", 2 * i + 2))]
    assert out == [*want, (20, 3, "a", 1), (30, 0, "a", 8)]
