"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no piece of the model can reach across: before a space
run and around characters that no piece holds. The distinct cuts ("words") of a
chunk of documents become flat numpy arrays of symbols. Each round looks up the
rank of every neighbouring pair, takes the minimum per word (a segmented
minimum), merges the leftmost non-overlapping pairs of that rank in all
words at once and compacts the arrays, until no pair is left.

Merging equal pairs at once equals the library's one-at-a-time order unless
a merge makes a pair that ranks better than the one just merged. Words where
that happens are started again with one (the leftmost) merge a round.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import chunks

SPACE = "▁"
NONE = np.iinfo(np.int32).max
#: Distinct words that a task remembers; at this number it starts anew.
CACHE_WORDS = 200_000


def read_model(path: str) -> bytes:
    """The model file, read where the job is planned (half a megabyte, a fixed size)."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces, single-byte pieces and the merge table of a BPE model."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.byte_id, self.surface, normal, score = {}, [], {}, {}
        self.spaced = np.zeros(n, bool)  # pieces whose space is dropped in front of a text
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i):
                self.surface.append(b"")
            elif sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                normal[piece], score[i] = i, sp.get_score(i)
                self.spaced[i] = piece.startswith(SPACE)
                self.surface.append(piece.replace(SPACE, " ").encode())
        self.single = {p: i for p, i in normal.items() if len(p) == 1}
        rank = {i: r for r, i in enumerate(sorted(score, key=lambda i: (-score[i], i)))}
        same = {}
        for i in sorted(score, key=rank.get):  # equal scores tie: the library then takes the leftmost pair
            rank[i] = same.setdefault(score[i], rank[i])
        pairs = []
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = normal.get(p[:k]), normal.get(p[k:])
                if left is not None and right is not None:
                    pairs.append((left * n + right, rank[i], i))
        pairs.sort()
        self.n = n
        self.keys = np.array([p[0] for p in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.ranks = np.array([p[1] for p in pairs] + [NONE], np.int32)
        self.merged = np.array([p[2] for p in pairs] + [-1], np.int32)
        code = np.full(0x110000, -1, np.int32)  # the piece of each character
        for c, i in self.single.items():
            code[ord(c)] = i
        self.code = np.where(code < 0, -1 - np.arange(0x110000, dtype=np.int32), code)
        self.cut = re.compile(self._cuts(normal))
        sizes = np.array([len(x) for x in self.surface], np.int64)
        self.surface_at = np.concatenate([[0], np.cumsum(sizes)])
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)

    @staticmethod
    def _cuts(normal: dict[str, int]) -> str:
        """The pattern of a word. Two neighbours are only cut apart if no piece holds both in a row."""
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            return r"(?s).+"
        held = {c for p in normal for c in p}
        alone = "".join(re.escape(c) for c in "\n\t" if c not in held)  # in no piece at all
        before = {(a, b) for p in normal for a, b in zip(p, p[1:]) if a != SPACE}
        late = set(".,!?;:#%&*$\"'()|") & held  # marks; no piece has one of them after a letter
        while joined := {(a, b) for a, b in before if b in late and a not in late}:
            words = {b for a, b in joined if a.isalpha()}
            late = late - words if words else late | {a for a, _ in joined}
        marks = "".join(map(re.escape, sorted(late)))
        mark = rf" *[{marks}]+[^ {marks}{alone}]*|" if marks else ""
        lone = rf"|[{alone}]+" if alone else ""
        return rf" *[^ {marks}{alone}]+|{mark} +{lone}"

    def words(self, text: str) -> list[str]:
        """The cuts of a text, after the library's space prefix and space mark."""
        return self.cut.findall(" " + text.replace(SPACE, " ")) if text else []

    def pairs(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of neighbours in the same word; NONE where no piece is."""
        key = left.astype(np.int64) * self.n + right
        at = np.searchsorted(self.keys, key)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0) & same
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.merged[at], -1)

    def rounds(self, words: list[str], one: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols and symbol counts of the words after all merges, and the words to do again one by one.

        Symbols below zero stand for characters without a piece: -1 minus the code point.
        """
        points = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        flat = self.code[points]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        last = np.full(len(words), -1, np.int32)  # the rank that was merged in the round before
        again, many = np.zeros(len(words), bool), np.zeros(len(words), bool)
        rank, into = self.pairs(flat[:-1], flat[1:], owner[:-1] == owner[1:])
        rank, into = np.append(rank, NONE), np.append(into, -1)
        done = []
        while len(flat):
            lead = np.append(True, owner[1:] != owner[:-1])
            starts = np.flatnonzero(lead)
            best = np.minimum.reduceat(rank, starts)
            ids = owner[starts]
            again[ids] |= many[ids] & (best < last[ids])
            last[ids] = best
            word = np.cumsum(lead) - 1
            best = best[word]
            if not (live := best < NONE).all():  # finished words leave the arrays
                done.append((flat[~live], owner[~live]))
                flat, owner, rank, into, best = flat[live], owner[live], rank[live], into[live], best[live]
                if not len(flat):
                    break
            # of equal best pairs in a row every second one merges, from the left end
            at = np.flatnonzero(rank == best)
            heads = np.append(True, at[1:] != at[:-1] + 1)
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(heads, nth, 0))) % 2 == 0]
            own = owner[at]
            lead = np.append(True, own[1:] != own[:-1])
            if one:
                at = at[lead]
            else:
                many[own] = False
                many[own[~lead]] = True
            flat[at] = into[at]
            keep = np.ones(len(flat), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # places after compaction
            flat, owner, rank, into = flat[keep], owner[keep], rank[keep], into[keep]
            near = np.zeros(len(flat), bool)
            near[at] = near[at[at > 0] - 1] = True
            near = np.flatnonzero(near)  # only pairs beside a merge are new
            right = np.minimum(near + 1, len(flat) - 1)
            rank[near], into[near] = self.pairs(flat[near], flat[right], (owner[near] == owner[right]) & (near < right))
        flat = np.concatenate([f for f, _ in done]) if done else flat
        owner = np.concatenate([o for _, o in done]) if done else owner
        flat = flat[np.argsort(owner, kind="stable")]
        return flat, np.bincount(owner, minlength=len(words)), np.flatnonzero(again)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row and their number by word; characters without a piece become their bytes."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        flat, sizes, again = self.rounds(words, one=False)
        if len(again):
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            slow, slow_sizes, _ = self.rounds([words[k] for k in again], one=True)
            for k, part in zip(again, np.split(slow, np.cumsum(slow_sizes)[:-1]), strict=True):
                parts[k] = part
            flat, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        if len(flat) and flat.min() < 0:
            owner = np.repeat(np.arange(len(words)), sizes)
            at = np.flatnonzero(flat < 0)
            spelt = [[self.byte_id[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")] for s in flat[at].tolist()]
            times = np.ones(len(flat), np.int64)
            times[at] = [len(x) for x in spelt]
            flat, owner = np.repeat(flat, times), np.repeat(owner, times)
            flat[flat < 0] = [i for x in spelt for i in x]
            sizes = np.bincount(owner, minlength=len(words))
        return flat.astype(np.int32), sizes


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + size]``, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _each_bad_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


def encoder(model: bytes):
    """A ``mapInArrow`` function that adds ``ids`` to (..., text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        known: dict[str, int] = {}  # the number of each word that was met
        table, starts, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in chunks(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            cut = [vocabulary.words(t or "") for t in texts]
            if len(known) > CACHE_WORDS:
                known, table, starts, sizes = {}, table[:0], starts[:0], sizes[:0]
            new = list(set().union(*cut).difference(known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                flat, more = vocabulary.encode(new)
                starts = np.concatenate([starts, len(table) + np.cumsum(more) - more])
                table, sizes = np.concatenate([table, flat]), np.concatenate([sizes, more])
            ends = np.cumsum([0, *map(len, cut)])
            at = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, ends[-1])
            flat = gather(table, starts[at], sizes[at])
            offsets = np.concatenate([[0], np.cumsum(sizes[at])])[ends]
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return run


def decoder(model: bytes):
    """A ``mapInArrow`` function that adds ``decoded`` to (..., ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        codecs.register_error("each_bad_byte", _each_bad_byte)
        at, size = vocabulary.surface_at, np.diff(vocabulary.surface_at)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index("ids"))
            for start in range(0, max(len(col), 1), 500):
                part = col.slice(start, 500)
                ids = part.flatten().to_numpy()
                counts = np.array([n or 0 for n in pa.compute.list_value_length(part).to_pylist()], np.int64)
                data = gather(vocabulary.surface_bytes, at[ids], size[ids])
                ends = np.concatenate([[0], np.cumsum(size[ids])])[np.concatenate([[0], np.cumsum(counts)])]
                data, ends = data.tobytes(), ends.tolist()
                # the space in front goes if it belongs to the first piece that shows
                shown = np.flatnonzero(size[ids] > 0)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                first = np.searchsorted(shown, bounds)
                drop = [int(k < m and vocabulary.spaced[ids[shown[k]]]) for k, m in zip(first, first[1:])]
                texts = [data[i + d:j].decode("utf-8", "each_bad_byte") for i, j, d in zip(ends, ends[1:], drop)]
                rows = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int): the library's encode, without begin or end ids.

    A null or empty text has no ids. Every row stands for itself, so repeated
    rows give repeated results; a column of ``docs`` named ids is replaced.
    Other columns pass through. One pass, no shuffle.
    """
    docs = docs.drop("ids").withColumn("text", F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(encoder(model), schema)


def decode(tokens: DataFrame, model: bytes) -> DataFrame:
    """``tokens`` with ``decoded`` (string): the library's decode of ``ids``; null ids give an empty text."""
    tokens = tokens.drop("decoded")
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    return tokens.mapInArrow(decoder(model), schema)


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` (..., text) with ``ids`` and ``decoded`` in place of text: encode, then decode, in one
    Python worker, so ids don't travel in between and a task needs one process."""
    docs = docs.drop("ids", "decoded").withColumn("text", F.col("text").cast("string"))
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        untexted = (b.drop_columns(["text"]) for b in encoder(model)(batches))
        yield from decoder(model)(untexted)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    tokens = round_trip(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
