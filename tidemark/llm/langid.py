"""Language identification in two steps: the family, then the language within it.

Linear support vector machines over hashed character n-grams, one against
one: first between language families, then between the languages of
the predicted family only, so close relatives are told apart by weights
that saw nothing else. All machines are fitted on a bounded sample of labelled texts
and every whole text is scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import chunks, id_text

# Family of a language code; any other code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
UNDETERMINED = "und"
#: Width of the hashed features, a power of two.
WIDTH = 8192
#: Texts to fit on: at most this many a language and in all, those with the least hash of their id.
PER_LANGUAGE, IN_ALL = 1_000, 4_000
#: Languages that are learned: the most frequent ones, equal counts by name.
MOST_LANGUAGES = 128
EPOCHS, RIDGE = 120, 1e-4


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0].split("_")[0] in codes), lang)


class Grams:
    """Hashed bigrams and trigrams of letters (lower case; all else is one boundary mark)."""

    def __init__(self):
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)  # surrogates are none
        self.fold = np.zeros(0x110000, np.uint64)
        letters = np.flatnonzero(self.letter)
        self.fold[letters] = np.fromiter((ord(chr(i).lower()[0]) for i in letters.tolist()), np.uint64, len(letters))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of all texts in a row, the end of each text's, and its number of letters."""
        # texts are kept apart by two marks, so that no gram spans two of them
        flat = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum([len(t) + 2 for t in texts])
        letters = np.concatenate([[0], np.cumsum(self.letter[flat])])
        c = self.fold[flat]
        # runs of marks count as one
        keep = (c > 0) | (np.append(c[:1], c[:-1]) > 0)
        keep[np.append(0, ends[:-1])] = True
        places = np.concatenate([[0], np.cumsum(keep)])[ends]
        c = c[keep] + np.uint64(1)
        b = np.append(c[1:], np.zeros(1, np.uint64))
        t = np.append(b[1:], np.zeros(1, np.uint64))
        two = (c * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(17)
        three = (two * np.uint64(0xFF51AFD7ED558CCD) + t * np.uint64(0x165667B19E3779F9)) >> np.uint64(19)
        grams = np.empty(2 * len(c), np.int64)
        grams[::2], grams[1::2] = two % WIDTH, three % WIDTH
        starts = np.concatenate([[0], ends[:-1]])
        return grams, 2 * places, letters[ends] - letters[starts]


def machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge, balanced sides): weights and bias, y in {-1, 1}."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    vw, vb, rate = np.zeros_like(w), 0.0, 0.2
    for _ in range(EPOCHS):  # accelerated gradient steps on the whole sample
        at, bt = w + 0.9 * vw, b + 0.9 * vb
        slack = np.maximum(0, 1 - y * (x @ at + bt)) * y * weight
        vw = 0.9 * vw + rate * (2 * (x.T @ slack) - RIDGE * at)
        vb = 0.9 * vb + rate * float(2 * slack.sum())
        w, b = w + vw, b + vb
    return w, b


def fit(texts: list[str], langs: list[str]) -> dict:
    """Machines by name: pairs of families, and pairs of languages of one family."""
    names = sorted(set(langs))
    groups = {f: [n for n in names if family(n) == f] for f in sorted({family(n) for n in names})}
    grams = Grams()
    counts = []  # of each text its features and how often they occur
    for t in texts:
        g, _, _ = grams.of([t])
        n = np.bincount(g, minlength=WIDTH)
        at = np.flatnonzero(n)
        counts.append((at.astype(np.uint16), n[at].astype(np.float32)))
    lang, fam = np.array(langs), np.array([family(n) for n in langs])
    machines = {}

    def duel(names: np.ndarray, a: str, b: str) -> tuple[np.ndarray, float]:
        rows = np.flatnonzero((names == a) | (names == b))
        x = np.zeros((len(rows), WIDTH), np.float32)  # only one duel's texts are spread out at a time, once: 128 MB at IN_ALL texts
        for i, r in enumerate(rows):
            at, n = counts[r]
            x[i, at] = np.sqrt(n)
            x[i:i + 1] /= np.maximum(np.linalg.norm(x[i:i + 1], axis=1, keepdims=True), 1e-9)
        return machine(x, np.where(names[rows] == a, 1.0, -1.0).astype(np.float32))

    for a, b in combinations(groups, 2):
        machines["family", a, b] = duel(fam, a, b)
    for members in groups.values():
        for a, b in combinations(members, 2):
            machines["language", a, b] = duel(lang, a, b)
    return {"groups": groups, "machines": machines}


def winner(candidates: list[str], margins: dict) -> tuple[str, float]:
    """The candidate with the most won duels (then the larger sum of margins) and the chance of its closest duel."""
    if len(candidates) == 1:
        return candidates[0], 1.0
    duel = {(a, b): m for (a, b), m in margins.items()} | {(b, a): -m for (a, b), m in margins.items()}
    best = max(candidates, key=lambda c: (sum(duel[c, o] > 0 for o in candidates if o != c), sum(duel[c, o] for o in candidates if o != c), c))
    closest = min(duel[best, o] for o in candidates if o != best)
    return best, float(1 / (1 + np.exp(-4 * np.clip(closest, -20, 20))))


def predict(model: dict, grams: Grams, texts: list[str]) -> list[tuple[str, float]]:
    """Language and score (the product of both steps' chances) of each text; no letter or no model: und and 0."""
    if not model["groups"]:
        return [(UNDETERMINED, 0.0)] * len(texts)
    g, ends, letters = grams.of(texts)
    starts = np.concatenate([[0], ends[:-1]])
    keys = list(model["machines"])
    margins = np.zeros((len(keys), len(texts)))
    if keys:
        w = np.stack([model["machines"][k][0] for k in keys])
        bias = np.array([model["machines"][k][1] for k in keys])
        for i, (s, e) in enumerate(zip(starts, ends)):
            counts = np.sqrt(np.bincount(g[s:e], minlength=WIDTH).astype(np.float32))
            margins[:, i] = (w @ counts) / max(float(np.linalg.norm(counts)), 1e-9) + bias
    out = []
    for i in range(len(texts)):
        if not letters[i]:
            out.append((UNDETERMINED, 0.0))
            continue
        at = {k: margins[n, i] for n, k in enumerate(keys)}
        fam, p = winner(list(model["groups"]), {k[1:]: m for k, m in at.items() if k[0] == "family"})
        members = model["groups"][fam]
        lang, q = winner(members, {k[1:]: m for k, m in at.items() if k[0] == "language" and k[1] in members})
        out.append((lang, p * q))
    return out


def sample(docs: DataFrame, folds: int, held: int) -> tuple[list[str], list[str]]:
    """At most PER_LANGUAGE texts of each learned language (fewer if there are many), outside the held-out fold.

    A share drawn by the hash of the id is cut to the bound on Spark, so that
    an id which many rows repeat sends no more than others to the driver.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held))
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not most:
        return [], []
    each = min(PER_LANGUAGE, IN_ALL // len(most))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    shares = F.create_map(*[F.lit(x) for r in most for x in (r["lang"], min(each / r["n"], 1.0))])
    drawn = rows.select("lang", "text", draw.alias("draw")).where(F.col("draw") <= F.element_at(shares, F.col("lang")))
    first = Window.partitionBy("lang").orderBy("draw", "text")
    got = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each).collect()
    got.sort(key=lambda r: (r["draw"], r["text"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def fold(id_col: str, folds: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in chunks(batches, 500_000):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            out = predict(model, grams, [t or "" for t in texts])
            found = [pa.array([x for x, _ in out], pa.string()), pa.array([p for _, p in out], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "lang_pred", "score"])

    return run


def train(docs: DataFrame, folds: int = 3, held: int = 1) -> dict:
    """The model, from text and non-null lang of documents outside the held-out fold.

    The sample is PER_LANGUAGE texts a language and IN_ALL in all at most, of the
    MOST_LANGUAGES most frequent languages; it is all that reaches the driver.
    Without labelled rows no language is known.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return fit(*sample(rows, folds, held))


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred and score of every whole text; ``und`` and 0 for null texts and texts without a letter.

    Every row stands for itself; columns of these names in ``docs`` are
    replaced, others pass through. One pass, no shuffle.
    """
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(scorer(model), schema)


def language_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: a model from two of three folds applied to all documents."""
    found = identify(id_text(docs), train(docs)).drop("text")
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
