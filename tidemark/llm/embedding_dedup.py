"""Embedding near-duplicates through a forest of random-projection trees.

Each tree splits at random directions, again and again. A split's threshold
lies between the quarter points, where the fewest projections are near, so that a
dense cluster is rather passed than cut; vectors close to it spill to both
sides. The trees' tops are fitted on a bounded sample and send every vector to
its buckets; within a bucket the same splits go on over the bucket's own
vectors down to small leaves. All vectors of a leaf are compared by exact
cosine in double precision, over all trees the links are united.

A dense node of the sample that stands for more than a bucket isn't split
either: its vectors go to blocks, and every pair of blocks is compared once.

Equal vectors are one node from the start. A leaf gives each vector the
list of its links, not rows of pairs; blocks only count them, and a pair
that shares several such nodes counts in the first of them alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import checkpoint_dir

THRESHOLD = 0.9
TREES, LEAF = 10, 256
#: The tops are fitted on at most this many vectors, drawn by the hash of their id.
SAMPLE = 16_384
#: Vectors of a bucket, about; the tops split until a bucket expects so many, as far as the sample can tell.
BUCKET, LEAST_SAMPLED = 4_096, 32
#: Part of a node's vectors that spill over a split, at most.
SPILL = 0.1
#: A node whose mean cosine over all pairs reaches this isn't split but compared whole.
DENSE = 0.75
SEED = 11


def split(x: np.ndarray, rng: np.random.Generator, threshold: float) -> tuple[np.ndarray, float, float] | None:
    """Direction, threshold and spill margin for the rows of ``x``; None where nothing sets them apart."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold) / x.shape[1])  # how far a link's two projections typically lie apart
    best, directions = None, rng.standard_normal((4, x.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    for quantiles in (np.linspace(0.3, 0.7, 9), np.linspace(0.02, 0.98, 49)):
        for direction in directions:
            p = np.sort(x @ direction)
            at = np.quantile(p, quantiles)
            near = np.searchsorted(p, at + reach) - np.searchsorted(p, at - reach)
            k = int(near.argmin())
            if p[0] < at[k] <= p[-1] and (best is None or near[k] < best[0]):
                wide = np.partition(np.abs(p - at[k]), int(len(p) * SPILL))[int(len(p) * SPILL)]
                best = (near[k], direction, float(at[k]), float(min(reach / 2, wide)))
        if best and 2 * best[0] <= len(x):  # else all those cuts go through a cluster that fills the middle: cut beside it
            break
    return best and best[1:]


def dense(x: np.ndarray) -> bool:
    """Mean cosine over all pairs: the squared length of the mean of unit vectors."""
    return float(np.square(x.mean(axis=0)).sum()) >= DENSE


def grow(x: np.ndarray, rows: np.ndarray, smallest: int, rng: np.random.Generator, threshold: float) -> Iterator[np.ndarray]:
    """The leaves (row numbers) of one tree over ``x[rows]``."""
    stack = [rows]
    while stack:
        rows = stack.pop()
        cut = None if len(rows) <= smallest or dense(x[rows]) else split(x[rows], rng, threshold)
        if cut is None:
            yield rows
            continue
        p = x[rows] @ cut[0]
        sides = [rows[p < cut[1] + cut[2]], rows[p >= cut[1] - cut[2]]]
        if max(map(len, sides)) == len(rows):  # ties: no split
            yield rows
        else:
            stack += sides


def fit_tops(x: np.ndarray, total: int, trees: int, threshold: float) -> list[list]:
    """For each tree nodes (direction, threshold, margin, left, right); node 0 is the top.

    A bucket is None, or the number of blocks if its vectors are dense and more than BUCKET, about.
    """
    smallest = max(LEAST_SAMPLED, len(x) * BUCKET // max(total, 1))
    tops = []
    for tree in range(trees):
        rng, nodes, stack = np.random.default_rng([SEED, tree]), [None], [(0, np.arange(len(x)))]
        while stack:
            at, rows = stack.pop()
            if len(rows) <= smallest:
                continue
            cut = None if dense(x[rows]) else split(x[rows], rng, threshold)
            if cut is None:
                nodes[at] = math.ceil(len(rows) / len(x) * total / BUCKET)
                continue
            p = x[rows] @ cut[0]
            nodes[at] = (*cut, len(nodes), len(nodes) + 1)
            nodes += [None, None]
            stack += [(len(nodes) - 2, rows[p < cut[1]]), (len(nodes) - 1, rows[p >= cut[1]])]
        tops.append(nodes)
    return tops


def unit(col: pa.Array, size: int) -> np.ndarray:
    x = np.asarray(col.flatten()).astype(np.float64).reshape(-1, size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def assigner(tops: list[list], size: int):
    """(id, mult, v) to (bucket, first, second, block, whole, id, mult, v): each vector's buckets in all trees.

    ``whole`` lists those of its buckets that are compared in blocks. To these a vector goes once
    for each pair (first, second) that its block is in; other buckets have block 0 only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, placed = unit(batch.column(2), size), []
            for tree, nodes in enumerate(tops):
                stack = [(0, np.arange(len(x)))]
                while stack:
                    at, rows = stack.pop()
                    if not len(rows):
                        continue
                    if nodes[at] is None or isinstance(nodes[at], int):
                        placed.append((tree * 2**32 + at, nodes[at], rows))
                        continue
                    direction, cut, margin, left, right = nodes[at]
                    p = x[rows] @ direction
                    stack += [(left, rows[p < cut + margin]), (right, rows[p >= cut - margin])]
            none = [np.zeros(0, np.int64)]
            member = np.concatenate([rows for _, blocks, rows in placed if blocks] or none)
            within = np.concatenate([np.full(len(rows), bucket, np.int64) for bucket, blocks, rows in placed if blocks] or none)
            ends = np.append(0, np.cumsum(np.bincount(member, minlength=len(x))))
            whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(within[np.argsort(member, kind="stable")]))
            salt = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for bucket, blocks, rows in placed:
                block = (salt[rows] % np.uint64(blocks or 1)).astype(np.int32)
                take = pa.array(rows)
                columns = [whole.take(take), *batch.take(take).columns]
                for other in range(blocks or 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), bucket, np.int64)), pa.array(np.minimum(block, other).astype(np.int32)),
                                                      pa.array(np.maximum(block, other).astype(np.int32)), pa.array(block), *columns],
                                                     names=["bucket", "first", "second", "block", "whole", "id", "mult", "v"])

    return run


def parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that each of n numbers reaches over links a-b, given from both ends."""
    part = np.arange(n)
    while True:
        new = part.copy()
        np.minimum.at(new, a, part[b])
        new = new[new]
        if (new == part).all():
            return part
        part = new


def members(whole: pa.ChunkedArray, bucket: int | None) -> np.ndarray:
    """Row by row a one for each bucket of the list (below ``bucket``, if given)."""
    whole = whole.combine_chunks()
    whole = whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole
    row, value = np.repeat(np.arange(len(whole)), whole.value_lengths().to_numpy()), whole.flatten().to_numpy()
    if bucket is not None:
        row, value = row[value < bucket], value[value < bucket]
    names, at = np.unique(value, return_inverse=True)
    out = np.zeros((len(whole), len(names)), np.float32)
    out[row, at] = 1
    return out


def blockwise(x: np.ndarray, mult: np.ndarray, other: np.ndarray, one: np.ndarray, two: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row, by their multiplicities, and the least row of its part, over all pairs of a row of ``one`` and one of ``two``."""
    same = one is two
    links, part, weight = np.zeros(len(x)), np.arange(len(x)), mult.astype(np.float64)
    for start in range(0, len(one), 512):
        rows = one[start:start + 512]
        near = x[rows] @ x[two].T >= threshold
        if other.shape[1]:
            near &= other[rows] @ other[two].T == 0
        if same:
            near[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
        a, b = np.nonzero(near)
        if not len(a):
            continue
        as_one = near.astype(np.float64)
        links[rows] += as_one @ weight[two]
        if not same:
            links[two] += weight[rows] @ as_one
        a, b, every = rows[a], two[b], np.arange(len(x))
        part = parts(len(x), np.concatenate([a, b, every, part]), np.concatenate([b, a, part, every]))
    return links.astype(np.int64), part


def comparer(size: int, threshold: float, leaf: int, whole: frozenset[int]):
    """A bucket, or of those in ``whole`` a pair of blocks, to rows (id, near, links, root).

    ``near`` has the links with their multiplicities, or ``links`` their number where blocks are
    compared; ``root`` is the least id of its part of the leaf or the blocks.
    """
    kind = pa.list_(pa.struct([("id", pa.int64()), ("mult", pa.int64())]))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.take(pa.array(np.argsort(table["id"].to_numpy())))  # least ids first, and the same trees at each run
        ids, mult = table["id"].to_numpy(), table["mult"].to_numpy()
        col = table["v"].combine_chunks()
        x = unit(col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col, size)
        bucket = table["bucket"][0].as_py()
        other = members(table["whole"], bucket if bucket in whole else None)  # pairs that share one of these are counted there
        if bucket in whole:
            block, first, second = table["block"].to_numpy(), table["first"][0].as_py(), table["second"][0].as_py()
            one = np.flatnonzero(block == first)
            links, part = blockwise(x, mult, other, one, one if first == second else np.flatnonzero(block == second), threshold)
            some = np.flatnonzero(links)
            return pa.table({"id": pa.array(ids[some]), "near": pa.array([[]] * len(some), pa.list_(pa.int64())), "copied": pa.array([[]] * len(some), kind),
                             "links": pa.array(links[some]), "root": pa.array(ids[part[some]])})
        own, lists, ends, roots = [], [], [0], []
        for rows in grow(x, np.arange(len(ids)), leaf, np.random.default_rng([SEED, bucket >> 32, bucket & 0xFFFFFFFF, 1]), threshold):
            rows = np.sort(rows)
            y, links = x[rows], []
            for start in range(0, len(rows), 512):  # in blocks, so that a dense leaf of any size fits
                near = y[start:start + 512] @ y.T >= threshold
                near[np.arange(len(near)), np.arange(start, start + len(near))] = False
                if other.shape[1]:
                    near &= other[rows[start:start + 512]] @ other[rows].T == 0
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
                own.append(ids[rows[start + a[heads]]])
                lists.append(rows[b])
                ends += (ends[-1] + np.append(heads[1:], len(a))).tolist()
                links.append((start + a, b, start + a[heads]))
            if links:
                part = parts(len(rows), np.concatenate([k[0] for k in links]), np.concatenate([k[1] for k in links]))
                roots.append(ids[rows[part[np.concatenate([k[2] for k in links])]]])
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        ends = np.array(ends, np.int64)
        near = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids[flat]))
        twice = np.concatenate([[0], np.cumsum(mult[flat] > 1)])
        copies = flat[mult[flat] > 1]
        values = pa.StructArray.from_arrays([pa.array(ids[copies]), pa.array(mult[copies])], names=["id", "mult"])
        copied = pa.ListArray.from_arrays(pa.array(twice[ends].astype(np.int32)), values)
        none = [np.zeros(0, np.int64)]
        return pa.table({"id": pa.array(np.concatenate(own or none)), "near": near, "copied": copied.cast(kind), "links": pa.array(np.zeros(len(near), np.int64)),
                         "root": pa.array(np.concatenate(roots or none))})

    return run


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF,
                     id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Links join vectors of one length whose cosine is at least ``threshold``,
    as far as some tree has both in a leaf (tests measure the recall). A vector that is null, empty, zero
    or holds a null or non-finite component links with nothing, and so does a
    row without an id, whose component_id is null. Repeated rows are links of one another.
    Labels and other columns are left out.
    """
    checkpoint_dir(vectors.sparkSession)
    kind = vectors.schema[vec_col].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(kind).alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = rows.withColumn("fine", F.coalesce(fine & F.col("vec_id").isNotNull(), F.lit(False)))
    classes = rows.where("fine").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("mult")).select("id", "mult", "v").checkpoint()
    near = None
    for size, total in [tuple(r) for r in classes.groupBy(F.size("v").alias("size")).count().orderBy("size").collect()]:
        of = classes.where(F.size("v") == size)
        draw = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
        sample = of.where(draw < SAMPLE / total).select("id", "v").toArrow().sort_by("id").slice(0, SAMPLE).column("v")
        tops = fit_tops(unit(sample.combine_chunks(), size), total, trees, threshold)
        whole = frozenset(tree * 2**32 + at for tree, nodes in enumerate(tops) for at, node in enumerate(nodes) if isinstance(node, int))
        placed = of.mapInArrow(assigner(tops, size), f"bucket long, first int, second int, block int, whole array<long>, id long, mult long, v {kind}")
        found = placed.groupBy("bucket", "first", "second").applyInArrow(
            comparer(size, threshold, leaf, whole), "id long, near array<long>, copied array<struct<id:long,mult:long>>, links long, root long")
        near = found if near is None else near.union(found)
    if near is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    # ids are told apart by hash; only those of vectors with copies carry a number, as structs are compared pair by pair
    distinct = lambda c: F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
    merged = near.groupBy("id").agg(distinct("near"), distinct("copied"), F.sum("links").alias("links"),
                                 F.collect_set("root").alias("roots")).checkpoint()
    found = components(merged.select(F.col("id").alias("a"), F.explode("roots").alias("b")))
    counted = merged.select(F.col("id").alias("own"), F.aggregate("copied", F.col("links") + F.size("near"), lambda s, n: s + n["mult"] - 1).alias("others"))
    classes = classes.join(counted, classes["id"] == counted["own"], "left").join(found, classes["id"] == found["node"], "left").select(
        F.col("v").alias("cv"), (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.join(classes, F.col("fine") & (F.col("v") == F.col("cv")), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
