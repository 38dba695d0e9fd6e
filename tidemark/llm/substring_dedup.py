"""Substring dedup: repeated passages found by suffix automata of reference shards.

A window of 20 words goes if an equal one starts earlier in the corpus.
Every window has an anchor, the least hash of its 8-word runs, so equal windows
have equal anchors and only passages that share an anchor need to meet:

1. Count the anchors (about one word in seven is one). A fixed-size bit
   table of those that occur twice goes to all tasks; false hits only cost work.
2. Cut each document into blocks, the runs of windows with one repeated anchor. Equal
   blocks are one row with their first place; every later place is repeated whole.
3. The distinct blocks of an anchor, in corpus order, are a reference. Tasks
   gather anchors into shards of bounded size, build a suffix automaton over
   a shard's blocks, and stream the blocks through it for matching statistics:
   where 20 words match whose first place is earlier, the window goes.
4. The spans meet their texts again and the kept words are joined.

A shard is dealt by anchor and not broadcast, because the reference grows with the corpus.
An anchor with more distinct blocks than a shard takes (the edge of a passage that stands
in very many surroundings) is cut into single windows, which combine
before the shuffle as equal blocks do. Windows count as equal if anchor and hash, 64 bits each, are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, text_bytes
from tidemark.session import checkpoint_dir

LENGTH, GRAM = 20, 8
#: The bit table of repeated anchors: 2**27 bits, 16 MB whatever the input.
TABLE_BITS = 27
#: Distinct blocks of an anchor that go into one shard, at most, and words of a shard, about.
SHARD_BLOCKS, SHARD_WORDS = 1_000, 60_000
CACHE_WORDS = 400_000
#: Orders rows without a doc_id after all others.
NO_ID = 2**63 - 1
U = np.uint64
BASE, INVERSE = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Hashes(dict):
    """Word to 64-bit hash, remembered up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


class Windows:
    """Hashes over the words of several documents in a row; nothing crosses a document's end."""

    def __init__(self, docs: list[list[bytes]], hashes: Hashes):
        sizes = np.array([len(d) for d in docs], np.int64)
        self.ends = np.cumsum(sizes)
        self.n = int(self.ends[-1]) if len(docs) else 0
        self.doc = np.repeat(np.arange(len(docs)), sizes)
        words = np.fromiter((h for d in docs for h in map(hashes.__getitem__, d)), U, self.n)
        power = np.full(self.n + 1, BASE)
        power[0] = 1
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(stir(words) * np.cumprod(power)[:-1], dtype=U)])
        power[1:] = INVERSE
        self.unshift = np.cumprod(power)
        left = self.ends[self.doc] - np.arange(self.n)  # words to the document's end
        self.gram_fits, self.fits = left >= GRAM, left >= LENGTH
        top = np.iinfo(U).max
        if self.n < LENGTH:
            self.grams = self.anchors = np.zeros(0, U)
            return
        grams = self.runs(np.arange(self.n - GRAM + 1), GRAM)
        self.grams = np.where(self.gram_fits[:len(grams)], grams, top)
        self.anchors = sliding(self.grams, LENGTH - GRAM + 1, np.minimum)  # of the window at each place
        self.fits = self.fits[:len(self.anchors)]

    def runs(self, starts: np.ndarray, size) -> np.ndarray:
        """Hash of the ``size`` words from each start."""
        return stir((self.sums[starts + size] - self.sums[starts]) * self.unshift[starts] + np.asarray(size).astype(U) * U(0xD6E8FEB86659FD93))

    def chosen(self) -> np.ndarray:
        """The grams that are some window's anchor, each place once."""
        if not len(self.anchors):
            return np.zeros(0, U)
        pad = np.zeros(LENGTH - GRAM, U)
        most = sliding(np.concatenate([pad, np.where(self.fits, self.anchors, U(0)), pad]), LENGTH - GRAM + 1, np.maximum)
        return self.grams[(most == self.grams) & self.gram_fits[:len(self.grams)]]

    def blocks(self, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of windows in ``wanted`` with one anchor: document, first window, windows, anchor, hash of the words, whether a window repeats inside."""
        at = np.flatnonzero(wanted)
        if not len(at):
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        anchor = self.anchors[at]
        new = np.append(True, (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (self.doc[at[1:]] != self.doc[at[:-1]]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - first) % (LENGTH - GRAM + 1) == 0  # one anchor place reaches no further
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(at)))
        block = np.cumsum(new) - 1
        windows = self.runs(at, LENGTH)
        order = np.lexsort((windows, block))
        same = (windows[order][1:] == windows[order][:-1]) & (block[order][1:] == block[order][:-1])
        inside = np.zeros(len(heads), bool)
        inside[block[order][1:][same]] = True
        start = at[heads]
        return self.doc[start], start - (self.ends[self.doc[start]] - self.sizes()[self.doc[start]]), sizes, anchor[heads], self.runs(start, sizes + LENGTH - 1), inside

    def sizes(self) -> np.ndarray:
        return np.diff(np.concatenate([[0], self.ends]))


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # bytes: cut at the six ASCII separators only


def count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for batch in chunks(batches):
        found, times = np.unique(Windows([split(t) for t in text_bytes(batch)], hashes).chosen(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.minimum(times, 2).astype(np.int32))], names=["anchor", "n"])


def bit_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated anchors of a partition to the set bits of its part of the table, as bytes by page of 64 kB."""
    pages: dict[int, np.ndarray] = {}
    for batch in batches:
        bits = batch.column(0).to_numpy().view(U) >> U(64 - TABLE_BITS)
        for page in np.unique(bits >> U(19)).tolist():
            own = (bits[bits >> U(19) == U(page)] & U(2**19 - 1)).astype(np.int64)
            np.bitwise_or.at(pages.setdefault(page, np.zeros(2**16, np.uint8)), own >> 3, (1 << (own & 7)).astype(np.uint8))
    yield pa.RecordBatch.from_arrays([pa.array(list(pages), pa.int32()), pa.array([p.tobytes() for p in pages.values()], pa.binary())], names=["page", "bits"])


def repeated_anchors(texts: DataFrame) -> bytes:
    """The bit table of the anchors that occur at least twice: its size is fixed, so it may pass through the driver."""
    twice = texts.select("id", "text").mapInArrow(count_anchors, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    page = F.shiftrightunsigned("anchor", 64 - TABLE_BITS + 19)
    # each page is made in one task, so that no more than the table itself is sent
    pages = twice.repartition(page).mapInArrow(bit_pages, "page int, bits binary")
    table = np.zeros((2 ** (TABLE_BITS - 19), 2**16), np.uint8)
    for row in pages.toLocalIterator():
        table[row["page"]] |= np.frombuffer(row["bits"], np.uint8)
    return table.tobytes()


def cut_blocks(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = Hashes(), np.frombuffer(table.value, np.uint8)
        for batch in chunks(batches):
            w = Windows([split(t) for t in text_bytes(batch)], hashes)
            place = (w.anchors >> U(64 - TABLE_BITS)).astype(np.int64)
            doc, start, n, anchor, content, inside = w.blocks((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool) & w.fits[:len(place)])
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(inside.astype(bool))],
                names=["id", "ver", "start", "n", "anchor", "content", "inside"])

    return run


def block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their blocks to the blocks' words; blocks of an overfull anchor to their single windows' hashes."""
    hashes = Hashes()
    names = ["key", "anchor", "id", "ver", "start", "words"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for batch in chunks(batches):
        out: list[list] = [[] for _ in names]
        ids, vers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (text, blocks) in enumerate(zip(text_bytes(batch), batch.column(3).to_pylist())):
            words = split(text)
            whole = [b for b in blocks if not b["full"]]
            single = {s: b["anchor"] for b in blocks if b["full"] for s in range(b["start"], b["start"] + b["n"])}
            keys = [b["anchor"] for b in whole]
            anchors = keys + list(single.values())
            places = [b["start"] for b in whole]
            texts = [b" ".join(words[b["start"]:b["start"] + b["n"] + LENGTH - 1]) for b in whole]
            if single:
                keys = keys + Windows([words], hashes).runs(np.array(list(single)), LENGTH).view(np.int64).tolist()
                places += single
                texts += [None] * len(single)
            for column, values in zip(out, (keys, anchors, [ids[i]] * len(keys), [vers[i]] * len(keys), places, texts)):
                column += values
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


class Automaton:
    """Suffix automaton over numbers; ``first`` is where the first occurrence of a state's strings ends."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [-1]
        self.last = 0

    def add(self, symbol: int) -> None:
        nxt, link, size, first = self.next, self.link, self.size, self.first
        p, new = self.last, len(nxt)
        nxt.append({})
        size.append(size[p] + 1)
        first.append(size[p])
        link.append(0)
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                size.append(size[p] + 1)
                first.append(first[q])
                link.append(link[q])
                while p >= 0 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def earlier(self, symbols: list[int], length: int) -> Iterator[tuple[int, int]]:
        """Matching statistics of a stream, cut at ``length``: (place after it, where the last ``length`` symbols first ended)."""
        nxt, link, size = self.next, self.link, self.size
        v = matched = 0
        for i, symbol in enumerate(symbols):
            while v and symbol not in nxt[v]:
                v = link[v]
                matched = size[v]
            if symbol in nxt[v]:
                v, matched = nxt[v][symbol], matched + 1
            while size[link[v]] >= length if v else False:
                v = link[v]
                matched = size[v]
            if matched >= length:
                yield i, self.first[v]


def shard_spans(blocks: list[tuple[int, int, int, list[bytes]]]) -> list[tuple[int, int, int]]:
    """Blocks (id, version, start, words) in corpus order by anchor to their windows (id, version, start) that stand earlier in the shard."""
    automaton, numbers = Automaton(), {}
    begin, owner, coded = [], [], []
    for k, (_, _, _, words) in enumerate(blocks):
        codes = [numbers.setdefault(w, len(numbers)) for w in words]
        begin.append(len(owner))
        coded.append(codes)
        for c in codes:
            automaton.add(c)
        automaton.add(-1 - k)  # ends the block: no match runs over it
        owner += [k] * (len(codes) + 1)
    out = []
    for (doc, ver, start, _), codes in zip(blocks, coded):
        for i, end in automaton.earlier(codes, LENGTH):
            k = owner[end]
            there = (blocks[k][0], blocks[k][2] + end - begin[k])
            if there < (doc, start + i):
                out.append((doc, ver, start + i - LENGTH + 1))
    return out


def match_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of anchor and place; whole anchors gather up to SHARD_WORDS words."""
    held: list[tuple] = []
    words, last = 0, None

    def done() -> pa.RecordBatch:
        found = shard_spans(held)
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
                                           pa.array([f[2] for f in found], pa.int32()), pa.array([LENGTH] * len(found), pa.int32())],
                                          names=["id", "ver", "start", "size"])

    for batch in batches:
        for key, doc, ver, start, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != last and words > SHARD_WORDS:
                yield done()
                held, words = [], 0
            last = key
            held.append((doc, ver, start, text.split()))
            words += len(held[-1][3])
    if held:
        yield done()


def keyed(docs: DataFrame) -> DataFrame:
    """id (never null), ver, text, doc_id: rows of one id and one text are one document, other texts of an id are versions of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.hash(text).alias("ver"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``keyed`` texts (id, ver, text) to id, ver, spans: arrays of (start, size) in words that windows starting earlier elsewhere cover."""
    spark = texts.sparkSession
    folder = f"{checkpoint_dir(spark)}/substrings-{uuid.uuid4().hex}"
    table = spark.sparkContext.broadcast(repeated_anchors(texts))
    texts.mapInArrow(cut_blocks(table), "id long, ver int, start int, n int, anchor long, content long, inside boolean").write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    place = F.struct("id", "start", "ver")
    first = blocks.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.count("*").alias("times"), F.max("inside").alias("inside"), F.first("n").alias("n"))
    # written, so that the join below shuffles both its sides afresh and a block with very many places can be split
    first.write.parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first")
    # every later place of an equal block is repeated whole
    known = first.where("times > 1").select(F.col("anchor").alias("a"), F.col("content").alias("c"), "first")
    copies = blocks.join(known, (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c"))).where(
        F.struct("id", "start") > F.struct("first.id", "first.start")).select("id", "ver", "start", (F.col("n") + LENGTH - 1).alias("size"))
    # anchors in several surroundings, or that repeat within a block
    several = first.groupBy("anchor").agg(F.count("*").alias("blocks"), F.max("inside").alias("inside")).where("blocks > 1 or inside").select(
        F.col("anchor").alias("a"), (F.col("blocks") > SHARD_BLOCKS).alias("full"))
    listed = first.join(several, F.col("anchor") == F.col("a")).groupBy(F.col("first.id").alias("bid"), F.col("first.ver").alias("bver")).agg(
        F.collect_list(F.struct(F.col("first.start").alias("start"), "n", "anchor", "full")).alias("blocks"))
    worded = texts.join(listed, (F.col("id") == F.col("bid")) & (F.col("ver") == F.col("bver"))).select("id", "ver", "text", "blocks")
    parts = worded.mapInArrow(block_words, "key long, anchor long, id long, ver int, start int, words binary")
    matched = parts.where("words is not null").drop("anchor").repartition("key").sortWithinPartitions("key", "id", "start", "ver").mapInArrow(
        match_shards, "id long, ver int, start int, size int")
    single = parts.where("words is null").select("key", "anchor", "id", "ver", "start")
    least = single.groupBy("key", "anchor").agg(F.min(F.struct("id", "start")).alias("least"), F.count("*").alias("times")).where("times > 1").select(F.col("key").alias("k"), F.col("anchor").alias("a"), "least")
    windows = single.join(least, (F.col("key") == F.col("k")) & (F.col("anchor") == F.col("a"))).where(F.struct("id", "start") > F.col("least")).select(
        "id", "ver", "start", F.lit(LENGTH).alias("size"))
    spans = copies.union(matched).union(windows)
    return spans.groupBy(F.col("id").alias("sid"), F.col("ver").alias("sver")).agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their spans to the kept words joined by one space."""
    for batch in chunks(batches):
        out: list[list] = [[], [], []]
        for text, spans in zip(text_bytes(batch), batch.column(2).to_pylist()):
            words = split(text)
            kept = words
            if spans:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [s["start"] for s in spans], 1)
                np.add.at(edge, [min(s["start"] + s["size"], len(words)) for s in spans], -1)
                covered = np.cumsum(edge)[:-1] > 0
                kept = [w for w, c in zip(words, covered.tolist()) if not c]
            for column, value in zip(out, (len(words), len(words) - len(kept), b" ".join(kept))):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) of every row.

    A window is judged on the input: it goes if an equal one starts at a
    smaller doc_id, or earlier in the same document. Null and empty texts have no words.
    Rows without a doc_id come after all others, as versions of one document (that of the greatest long, if there is one). Rows
    with one doc_id and one text are one document, so neither is earlier,
    and repeat in the result. Other columns are left out. The texts move once.
    """
    texts = keyed(docs)
    spans = repeated_spans(texts.select("id", "ver", "text"))
    joined = texts.join(spans, (F.col("id") == F.col("sid")) & (F.col("ver") == F.col("sver")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")


def substring_query(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
