"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult (weighted), threat, target, negation, reporting,
clause end, other. Four small transducers rewrite a clause's symbols, each
looking for one context: an insult in a negation's scope, in reported speech,
an insult or threat aimed at a target. They are composed into one machine, which runs
over every clause that holds an insult or threat; weights sum by context.
What a context counts for is learned with a logistic model, and so are the
insults: words and word beginnings that labelled toxic texts hold and clean ones don't.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, id_text
from tidemark.llm.langid import fold

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]|[\"“”«»]")
# Closed word classes of the grammar in four languages.
TARGETS = frozenset("you your yours yourself he she him her they them their du dich dir dein deine ihr euch euer sie er tu te toi ton ta vous votre il elle ils tú ti tus usted ustedes él ella ellos vosotros".split())
NEGATIONS = frozenset("not never no isn't nobody nicht kein keine niemals nie ne pas jamais aucun nunca ningún ninguna jamás".split())
REPORTS = frozenset("said says wrote claims claimed called quoted allegedly sagte sagt schrieb behauptet angeblich dit écrit prétend aurait dijo dice escribió afirma supuestamente".split())
THREATS = frozenset("kill hurt destroy beat burn töten umbringen schlagen verletzen tuer frapper détruire matar golpear destruir".split())
#: Words that a negation reaches.
SCOPE = 3
#: Labelled texts to fit on, at most: those with the least hash of their id.
TOXIC_ROWS, CLEAN_ROWS = 1_500, 3_000
#: An insult is in at least this many toxic texts of the sample and this share of them, at this precision.
LEAST_TEXTS, LEAST_SHARE, PRECISION = 4, 0.004, 0.95
#: Word beginnings of these lengths may stand for a stem.
STEMS = (4, 5, 6, 7)
CACHE_WORDS = 300_000
#: Contexts, in the order of the features.
CONTEXTS = ("I", "I@", "I-", "I\"", "H", "H@")
Transducer = dict  # (state, symbol) -> (state, symbol); what is missing keeps both


def negation() -> Transducer:
    """Insults within SCOPE words after a negation."""
    arcs = {(s, "neg"): (SCOPE, "o") for s in range(SCOPE + 1)} | {(s, "end"): (0, "end") for s in range(SCOPE + 1)}
    for s in range(1, SCOPE + 1):
        arcs |= {(s, x): (s - 1, x) for x in ("o", "tgt", "rep", "quote", "H")} | {(s, "I"): (s - 1, "I-")}
    return arcs


def reported() -> Transducer:
    """Insults after a reporting word, or inside quotation marks, to the clause's end."""
    arcs = {(0, "rep"): (1, "o"), (0, "quote"): (2, "o"), (1, "quote"): (2, "o"), (2, "quote"): (0, "o")}
    for s in (1, 2):  # after a reporting word, inside quotation marks
        arcs |= {(s, "rep"): (s, "o"), (s, "I"): (s, "I\""), (s, "I-"): (s, "I\""), (s, "end"): (0, "end")}
    return arcs


def aimed(symbol: str) -> Transducer:
    """Insults or threats with a target earlier in the clause."""
    return {(0, "tgt"): (1, "tgt"), (1, symbol): (1, symbol + "@"), (1, "end"): (0, "end")}


def compose(*machines: Transducer) -> tuple[dict, dict]:
    """One table of all: the output of each is the input of the next. States are numbered; 0 starts."""
    alphabet = ["o", "I", "H", "tgt", "neg", "rep", "quote", "end"]
    states = list(product(*[sorted({0} | {s for s, _ in m}) for m in machines]))
    number = {s: i for i, s in enumerate(states)}
    move, out = {}, {}
    for state in states:
        for symbol in alphabet:
            after, x = [], symbol
            for s, m in zip(state, machines):
                s, x = m.get((s, x), (s, x))
                after.append(s)
            move[number[state], symbol], out[number[state], symbol] = number[tuple(after)], x
    return move, out


class Grammar:
    """The composed machine with its insult weights."""

    def __init__(self, insults: dict[str, float], stems: dict[str, float]):
        self.insults, self.stems = insults, stems
        self.move, self.out = compose(negation(), reported(), aimed("I"), aimed("H"))
        self.known: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        low = word.lower()
        if low in self.insults:
            return "I", self.insults[low]
        for n in reversed(STEMS):
            if len(low) > n and low[:n] in self.stems:
                return "I", self.stems[low[:n]]
        if low in THREATS:
            return "H", 1.0
        for name, words in (("tgt", TARGETS), ("neg", NEGATIONS), ("rep", REPORTS)):
            if low in words:
                return name, 0.0
        return ("quote" if word in "\"“”«»" else "end" if word in ".!?;:\n" else "o"), 0.0

    def features(self, text: str) -> list[float]:
        """Summed weights by context, the worst clause, and hits over the text's length."""
        tokens = TOKEN.findall(text)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        for w in set(tokens).difference(known):
            known[w] = self.symbol(w)
        symbols = [known[w] for w in tokens]
        hits = [i for i, (s, _) in enumerate(symbols) if s in ("I", "H")]
        sums, worst, done = dict.fromkeys(CONTEXTS, 0.0), 0.0, -1
        for i in hits:
            if i <= done:
                continue  # its clause was scored
            start = i
            while start > 0 and symbols[start - 1][0] != "end":
                start -= 1
            state, clause, at = 0, 0.0, start
            while at < len(symbols) and (symbols[at][0] != "end" or at < i):
                s, weight = symbols[at]
                out = self.out[state, s]
                state = self.move[state, s]
                if out in sums:
                    sums[out] += weight
                    clause += weight * (0.25 if out in ("I-", "I\"", "H") else 1.0)
                at += 1
            done, worst = at, max(worst, clause)
        return [math.log1p(sums[c]) for c in CONTEXTS] + [math.log1p(worst), math.log1p(100 * len(hits) / max(len(tokens), 1))]


def distinct(texts: list[str]) -> list[str]:
    """One text of each group of near copies (by its least run of four words), so that a copied text's words don't pass for insults."""
    seen = {}
    for t in texts:
        words = TOKEN.findall(t.lower())
        runs = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
        seen.setdefault(min(runs, key=lambda r: hash_text(r)), t)
    return list(seen.values())


def hash_text(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s)


def lexicon(toxic: list[str], clean: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Insults and stems with their weight: the log-odds of a text being toxic, over the greatest such."""

    def counts(texts: list[str]) -> tuple[Counter, Counter]:
        whole, begin = Counter(), Counter()
        for t in texts:
            words = {w for w in TOKEN.findall(t.lower()) if len(w) > 2}
            whole.update(words)
            begin.update({w[:n] for w in words for n in STEMS if len(w) > n})
        return whole, begin

    toxic, clean = distinct(toxic), distinct(clean)
    (tw, tb), (cw, cb) = counts(toxic), counts(clean)
    least = max(LEAST_TEXTS, LEAST_SHARE * len(toxic))

    def pick(t: Counter, c: Counter) -> dict[str, float]:
        out = {}
        for w, n in t.items():
            share, other = n / max(len(toxic), 1), c[w] / max(len(clean), 1)
            if n >= least and share >= PRECISION * (share + other):
                out[w] = math.log((share + 1e-4) / (other + 0.5 / max(len(clean), 1)))
        return out

    words, stems = pick(tw, cw), pick(tb, cb)
    # a beginning stands for a stem if several words share it, each too rare to be picked for itself
    stems = {s: v for s, v in stems.items() if tb[s] > 1.5 * max((tw[w] for w in words if w.startswith(s)), default=0)}
    top = max([*words.values(), *stems.values(), 1.0])
    return {w: v / top for w, v in words.items()}, {w: v / top for w, v in stems.items()}


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a ridge logistic model, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * 0.05
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> dict:
    """The model, from labelled documents outside the held-out fold.

    TOXIC_ROWS and CLEAN_ROWS texts at most, those with the least hash of
    their id; their ids are broadcast, so no text is shuffled, and they are
    all that reaches the driver. Of an id's several labels the greatest
    counts, null labels don't. Without both kinds the score is the prior.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    marked = marked.where(fold("doc_id", folds) != held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for value, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        part = marked.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.union(part)
    rows = id_text(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    toxic, clean = ([r["text"] for r in rows if r["toxic"] == k] for k in (1, 0))
    if not toxic or not clean:
        return {"insults": {}, "stems": {}, "weights": [0.0] * (len(CONTEXTS) + 2) + [2.0 if toxic else -2.0]}
    # insults come from one half, what contexts count for from the other; then insults from all
    insults, stems = lexicon(toxic[::2], clean[::2])
    grammar = Grammar(insults, stems)
    x = np.array([grammar.features(t) for t in toxic[1::2] + clean[1::2]] or [[0.0] * (len(CONTEXTS) + 2)])
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(clean[1::2]) or [0.0])
    insults, stems = lexicon(toxic, clean)
    return {"insults": insults, "stems": stems, "weights": logistic(x, y).tolist()}


def scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, w = Grammar(model["insults"], model["stems"]), np.array(model["weights"])
        for batch in chunks(batches):
            x = np.array([grammar.features(t or "") for t in batch.column(1).to_pylist()])
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score of every whole text (null: empty). Every row stands for itself; one pass, no shuffle."""
    return id_text(docs).mapInArrow(scorer(model), "doc_id long, score double")


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: a model from four of five folds applied to all documents."""
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
