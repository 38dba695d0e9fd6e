"""Token counts by a unigram model over a trie of distinct pre-tokens.

The distinct pre-tokens (a space mark with a run of word characters or of marks, or a run of white space) of a chunk of
documents are put in order, which walks their trie depth first: neighbours
share a prefix, and the forward scores along it are kept. Each new trie
node looks back over the pieces that end there, through a trie of reversed
pieces, and stores the best score and its number of tokens. What stands at a
pre-token's last node is its terminal count; a document's count is the sum.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import chunks, id_text

SPACE = "▁"
PRE_TOKEN = re.compile(r" *\w+| *[^\w\s]+|\s+")
#: Distinct pre-tokens that a task remembers; at this number it starts anew.
CACHE_WORDS = 400_000
#: A character that no piece holds costs this much below the worst piece, and a token for each byte.
UNKNOWN_PENALTY = 10.0


def scores(model: bytes) -> dict[str, float]:
    """Log probability of each piece: Zipf's law over the vocabulary's order, ``-ln(rank + 1)`` less its norm.

    The model file ranks its pieces; their own scores are ranks, not
    probabilities, so sums of them would not compare segmentations of
    different lengths.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    norm = float(np.log(np.sum(1.0 / np.arange(1, len(ids) + 1))))
    return {sp.id_to_piece(i): -float(np.log(r + 1)) - norm for r, i in enumerate(ids)}


def reversed_trie(pieces: dict[str, float]) -> dict:
    """Nested dicts over the characters of each piece from its end; "" holds the score."""
    root: dict = {}
    for piece, score in pieces.items():
        node = root
        for c in reversed(piece):
            node = node.setdefault(c, {})
        node[""] = score
    return root


def terminal_counts(words: list[str], trie: dict, unknown: float) -> list[int]:
    """Tokens of each word's best segmentation; ``words`` must be sorted.

    Ties go to fewer tokens.
    """
    best: list[float] = [0.0]
    count: list[int] = [0]
    out, before = [], ""
    for word in words:
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for j in range(shared, len(word)):
            top, fewest = best[j] + unknown, count[j] + len(word[j].encode("utf-8", "surrogatepass"))
            node, i = trie.get(word[j]), j
            while node is not None:
                score = node.get("")
                if score is not None:
                    score += best[i]
                    if score > top or (score == top and count[i] + 1 < fewest):
                        top, fewest = score, count[i] + 1
                i -= 1
                if i < 0:
                    break
                node = node.get(word[i])
            best.append(top)
            count.append(fewest)
        out.append(count[len(word)])
        before = word
    return out


def counter(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = scores(model)
        trie, unknown = reversed_trie(pieces), min(pieces.values()) - UNKNOWN_PENALTY
        known: dict[str, int] = {}
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            cut = [PRE_TOKEN.findall((" " + t).replace(" ", SPACE).replace(SPACE, " ")) if t else [] for t in texts]
            if len(known) > CACHE_WORDS:
                known = {}
            new = sorted(w.replace(" ", SPACE) for w in set().union(*cut).difference(known))
            known.update(zip((w.replace(SPACE, " ") for w in new), terminal_counts(new, trie, unknown), strict=True))
            sizes = np.array([len(c) for c in cut], np.int64)
            n = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
            sums = np.concatenate([[0], np.cumsum(n)])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(sums[ends[1:]] - sums[ends[:-1]])],
                names=["doc_id", "n_pretokens", "n_tokens"])

    return run


def token_counts(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every text under the unigram model.

    A null or empty text counts 0 and 0. Every row stands for itself: repeated
    rows give repeated results. Other columns are left out. One pass, no shuffle.
    """
    return id_text(docs).mapInArrow(counter(model), "doc_id long, n_pretokens long, n_tokens long")
