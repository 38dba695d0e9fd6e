"""SimHash near-duplicates over deletion-variant signatures.

A fingerprint is cut into so few segments that, of the allowed differing bits,
at least one segment holds at most one. Each segment is indexed once for
each of its bits with that bit left out (a wildcard), so two fingerprints that
are near enough share a key whatever they differ in; whoever meets under a
key is verified on all 64 bits.

Equal fingerprints are one node from the start, so a group of copies of any
size costs one row. A key's nodes are never paired out: small groups are
compared at shifted places of the sorted column, larger ones are walked
breadth first, which emits a spanning forest only. No task holds a key of very
many nodes: they are dealt anew by the bits outside the key's segment, cut
into one piece more than bits may differ, so near nodes agree on one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, text_bytes
from tidemark.llm.components import components
from tidemark.session import checkpoint_dir

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Groups up to this size are compared pair by pair at shifted places; larger ones are walked.
SMALL_GROUP = 16
#: Larger groups are dealt anew by further pieces of their bits, at most this many times.
LARGE_GROUP, REFINEMENTS = 4_096, 2


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits: each set if over half of the shingles' XXH64 have it set; no words: zero."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII separators only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = np.append(0, ends)[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[i:j], SEED) for i, j in zip(starts, stops)], "<u8")
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<i8")[0])


def fingerprinter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [fingerprint(t, shingle) for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=["doc_id", "fp"])

    return run


def segments(max_bits: int) -> list[list[int]]:
    """The bits of each segment: as few as leave one with at most one of ``max_bits`` differing bits."""
    n = max(1, max_bits // 2 + 1)
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): one row for each bit, with the bit's segment less that bit as the key. The key's last six bits name the bit."""
    keys = []
    for bits in segments(max_bits):
        for bit in bits:
            mask = signed(sum(1 << b for b in bits if b != bit))
            keys.append(F.xxhash64(F.col("fp").bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(-64)).bitwiseOR(F.lit(bit)))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def segment_of(key: np.ndarray, max_bits: int) -> np.ndarray:
    """The bits (as a mask) of the segment that a key of ``variants`` is about."""
    masks = np.zeros(64, np.uint64)
    for bits in segments(max_bits):
        masks[bits] = sum(1 << b for b in bits)
    return masks.view(np.int64)[key & 63]


def refined(key: np.ndarray, used: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of large groups, once for each piece of the bits not yet ``used``, under a key that tells the piece's value too."""
    for mask in np.unique(used):
        rows = used == mask
        bits = [b for b in range(64) if not int(mask) >> b & 1]
        for n, piece in enumerate(np.array_split(bits, max_bits + 1), 1):
            own = np.int64(signed(sum(1 << int(b) for b in piece)))
            x = key[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)  # equal keys of unlike rows cost a comparison only
            x = (x ^ (x >> np.uint64(31)) ^ (fp[rows] & own).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(fp[rows]), pa.array(np.full(len(x), mask | own))], names=["a", "b", "used"])


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))  # of signed numbers it would count the absolute value's


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all that ``max_bits`` connect: each node takes what is near it from those not yet reached."""
    out, rest = [], np.unique(fps)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = popcount(rest ^ at) <= max_bits
            if near.any():
                out += [(int(at), int(x)) for x in rest[near]]
                queue += list(rest[near])
                rest = rest[~near]
    return out


def linker(max_bits: int, level: int):
    """Rows (key, fp[, used]) in key order to verified links (a, b, null), and those of large groups to ``refined`` rows.

    A key may run over batches. Of a group that will be dealt anew no more than LARGE_GROUP rows and a batch are held.
    """
    most = LARGE_GROUP if level < REFINEMENTS else 1 << 62

    def links(key: np.ndarray, used: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        each = np.repeat(sizes, sizes)
        if (sizes > most).any():
            yield from refined(key[each > most], used[each > most], fp[each > most], max_bits)
        small_key, small_fp = key[each <= SMALL_GROUP], fp[each <= SMALL_GROUP]
        for shift in range(1, SMALL_GROUP):
            if len(small_key) <= shift:
                break
            same = small_key[shift:] == small_key[:-shift]
            if not same.any():
                break
            x, y = small_fp[shift:][same], small_fp[:-shift][same]
            near = popcount(x ^ y) <= max_bits
            a.append(x[near])
            b.append(y[near])
        walked = (sizes > SMALL_GROUP) & (sizes <= most)
        for s, n in zip(starts[walked], sizes[walked]):
            found = forest(fp[s:s + n], max_bits)
            a.append(np.array([x for x, _ in found], np.int64))
            b.append(np.array([y for _, y in found], np.int64))
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64())], names=["a", "b", "used"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # the last key's rows so far
        passing = None  # a large key whose rows go on as they come

        def joined() -> list[np.ndarray]:
            return [np.concatenate(x) for x in zip(*held)]

        for batch in batches:
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            part = (key, batch.column(2).to_numpy() if level else segment_of(key, max_bits), fp)
            if passing is not None and len(key):
                n = int(np.searchsorted(key, passing, "right"))
                yield from refined(*(x[:n] for x in part), max_bits)
                part = tuple(x[n:] for x in part)
                key = part[0]
            if not len(key):
                continue
            passing = None
            cut = int(np.searchsorted(key, key[-1]))  # rows of the last key may go on
            if cut or held and held[-1][0][-1] != key[-1]:
                held.append(tuple(x[:cut] for x in part))
                yield from links(*joined())
                held = []
            held.append(tuple(x[cut:] for x in part))
            if sum(len(x[0]) for x in held) > most:
                yield from refined(*joined(), max_bits)
                held, passing = [], key[-1]
        if held:
            yield from links(*joined())

    return run


def near_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` to links (a, b) that connect all within ``max_bits`` bits."""
    rows, found = variants(fps, max_bits), []
    for level in range(REFINEMENTS + 1):
        out = rows.repartition("key").sortWithinPartitions("key").mapInArrow(linker(max_bits, level), "a long, b long, used long").checkpoint()
        found.append(out.where("used is null").select("a", "b"))
        large = out.where("used is not null")
        if large.isEmpty():
            break
        rows = large.select(F.col("a").alias("key"), F.col("b").alias("fp"), "used")
    return reduce(DataFrame.union, found).distinct()


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id that links reach) of every row.

    Null and empty texts have fingerprint zero and link as any other. Rows
    without a doc_id are fingerprinted but are no one's least id; where
    a component has none at all, component_id is null. Repeated rows repeat in
    the result. Other columns are left out.
    """
    checkpoint_dir(docs.sparkSession)
    rows = id_text(docs).mapInArrow(fingerprinter(shingle), "doc_id long, fp long").checkpoint()
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    found = components(near_fingerprints(classes.select("fp"), max_bits))
    grouped = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(ids, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` without copies: the row of each component's least doc_id stays, once.

    Rows without a doc_id can't be named by a component and stay. The texts
    move once, to meet the kept ids.
    """
    kept = groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("kept_id")).agg(F.count("*").alias("times")).checkpoint()

    def of(ids: DataFrame) -> DataFrame:
        return docs.join(ids.select("kept_id").hint("shuffle_hash"), docs["doc_id"] == F.col("kept_id"), "left_semi")

    out = of(kept.where("times = 1")).union(docs.where("doc_id is null"))
    repeated = kept.where("times > 1")
    return out if repeated.isEmpty() else out.union(of(repeated).dropDuplicates(["doc_id"]))
