"""Personal data by fixed patterns and a semi-Markov conditional random field.

Four base patterns (email, ip, card, phone) always hold. Around every token
with a digit, an @, a key word and separator or a known key prefix the field then scores whole candidate spans of up to
four tokens: their shape, length, checksum and the word before. Dynamic programming over bounded spans picks
boundaries and kinds together; what it finds clear of the base spans
is added. It is fitted by likelihood on a bounded sample of texts marked by the
base patterns and, for secrets, by key words: whole-span features carry
over to forms that no pattern lists.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import chunks, id_text

#: Kinds in listed order; the base ones first. The field adds all but "none".
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
#: Tokens of a candidate span, at most, and of context on both sides of an island.
LONGEST, CONTEXT = 4, 3
#: Texts to fit on: at most this many with a signal, those with the least hash of their id.
FIT_ROWS, EPOCHS, RATE, RIDGE = 400, 12, 0.3, 1e-4
#: A span is added if this likely given its island.
SURE = 0.5
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LOCAL_CHARS = "".join(sorted(LOCAL))
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A key word, a separator and the value; or a well-known key prefix. Used to mark the fitting sample only.
SECRET = re.compile(r"(?i:\b(?:password|passwd|token|secret|api_?key)\b)\x20?[=:]\x20?\"?[A-Za-z0-9_-]{8,}\"?|\b(?:AKIA|ASIA)[A-Z0-9]{12,}")
KEYWORDS = frozenset("password passwd token secret key apikey api_key email mail ip card phone tel version license".split())
#: What makes a span a candidate whatever else it holds; SECRET marks nothing without one.
KEYED = re.compile(r"(?i:\b(?:password|passwd|token|secret|api_?key)\b)\x20?[=:]|\b(?:AKIA|ASIA)[A-Z0-9]{12,}")
SIGNAL = re.compile(KEYED.pattern + "|[0-9@]")
#: A token never spans more characters; longer ones are cut, so a text without spaces stays bounded in work.
TOKEN_CHARS = 200
TOKEN = re.compile(r"\S{1,%d}" % TOKEN_CHARS)
#: What a secret goes on with where its last token was cut.
TAIL = re.compile(r"[A-Za-z0-9_.~+/=-]*+")
EDGES = ".,;:!?\"'()[]{}<>|*#%&$"
Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base patterns, leftmost and non-overlapping by kind, in linear time."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:  # each match holds exactly one @: its local part is the run before it
        before = text[last:at]
        start = last + len(before.rstrip(LOCAL_CHARS))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end(), "email"))
        last = domain.end() if domain else at + 1
        at = text.find("@", last)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered(spans))


def islands(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens (start, end) around those with a signal, with CONTEXT tokens before and after.

    No token is cut at an end of its run; of a word without spaces longer than tokens are, up to CONTEXT more tokens belong to it.
    """
    hits = [m.span() for m in SIGNAL.finditer(text)]
    ends = [b for _, b in hits]
    reach, done = 0, 0
    while reach < len(hits):
        first = last = hits[reach][0]
        left = max(text.rfind("\n", done, first) + 1, first - 60, done)
        head = text[max(done, left - TOKEN_CHARS * CONTEXT):left]
        left -= len(re.search(r"\S*\Z", head).group())
        tokens, more = [], 0
        for m in TOKEN.finditer(text, left):
            a, b = m.span()
            while reach < len(hits) and last - first < 2_000 and (hits[reach][0] < b or hits[reach][0] - last <= 60):
                last = hits[reach][1] - 1
                reach += 1
            if a >= last + 60:
                more += 1
                if not tokens or tokens[-1][1] != a or more > CONTEXT:
                    break
            tokens.append((a, b))
        inside = [i for i, (a, b) in enumerate(tokens) if (k := bisect_right(ends, a)) < len(hits) and hits[k][0] < b]
        if inside:
            tokens = tokens[max(0, inside[0] - CONTEXT):inside[-1] + 1 + CONTEXT]
            done = tokens[-1][0]
            yield tokens


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the marks at its edges (a leading plus sign and inner quotes stay)."""
    s = text[start:end]
    left = len(s) - len(s.lstrip(EDGES))
    right = len(s.rstrip(EDGES))
    return start + left, max(start + right, start + left)


def covers(text: str, tokens: list[tuple[int, int]], i: int, j: int, a: int, b: int) -> bool:
    """Whether tokens i to j are just those that a to b lies in: a key's value may go on in its last token."""
    return tokens[i][0] <= a < tokens[i][1] and tokens[j - 1][0] < b <= tokens[j - 1][1]


def likely(s: str) -> bool:
    """Whether a span holds enough to be of any kind: an @, six digits, points between digits, a key word and separator, or a digit in a long token or beside a key."""
    digits = sum(map(s.count, "0123456789"))
    return "@" in s or digits >= 6 or digits > 0 and ("=" in s or s.count(".") >= 3 or max(map(len, s.split())) >= 16) or KEYED.search(s) is not None


def shape(s: str) -> str:
    s = re.sub(r"[0-9]+", "0", s[:120])
    s = re.sub(r"[^\W\d_]+", "a", s)
    return re.sub(r"(?:0a|a0)[0a]+", "x", s)[:24]


def features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Of tokens i to j as one span."""
    start, end = trimmed(text, tokens[i][0], tokens[j - 1][1])
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    before = text[slice(*tokens[i - 1])].strip(EDGES).lower() if i else "^"
    out = ["bias", f"n{j - i}", f"shape={shape(s)}", f"d{min(len(digits), 20)}", f"len{min(len(s).bit_length(), 8)}"]
    if before in KEYWORDS:
        out.append(f"before={before}")
    if "@" in s:
        out.append(f"at{s.count('@')}{'.' in s.rpartition('@')[2]}")
    if len(digits) >= 12:
        out.append(f"luhn{luhn(digits)}{len(digits) == len(s)}")
    parts = s.split(".")
    if len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts):
        out.append(f"octets{all(len(p) < 4 and int(p) < 256 for p in parts)}")
    key = re.match(r"([A-Za-z_]+)\s?[=:]", s)
    if key:
        out += [f"key={key[1].lower()}", f"keyword{key[1].lower() in KEYWORDS}"]
    if s[:1] == "+":
        out.append("plus")
    if re.fullmatch(r"[A-Z0-9]{16,}", s) and digits != s:
        out.append("capitals")
    return out


class Field:
    """Weights by (kind, feature); segments of kind "none" are single tokens with score 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.w = defaultdict(float, weights or {})

    def lattice(self, text: str, tokens: list[tuple[int, int]]) -> tuple[dict, dict]:
        feats, score = {}, {}
        for i in range(len(tokens)):
            for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
                if not likely(text[tokens[i][0]:tokens[j - 1][1]]):
                    continue
                f = feats[i, j] = features(text, tokens, i, j)
                for k in KINDS:
                    score[i, j, k] = sum(self.w[k, x] for x in f)
        return feats, score

    @staticmethod
    def marginals(n: int, score: dict) -> dict:
        """Chance of each segment given the tokens: forward and backward sums over bounded segments."""
        into, out_of = defaultdict(list), defaultdict(list)
        for i, j, k in score:
            into[j].append((i, j, k))
            out_of[i].append((i, j, k))

        def add(terms: list[float]) -> float:
            top = max(terms)
            return top + math.log(sum(math.exp(t - top) for t in terms))

        a, b = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            a[j] = add([a[j - 1], *(a[s[0]] + score[s] for s in into[j])])
        for i in range(n - 1, -1, -1):
            b[i] = add([b[i + 1], *(b[s[1]] + score[s] for s in out_of[i])])
        return {s: math.exp(a[s[0]] + v + b[s[1]] - a[n]) for s, v in score.items()}

    def best(self, n: int, score: dict) -> list[tuple[int, int, str]]:
        """The most likely segmentation's spans."""
        into = defaultdict(list)
        for s in score:
            into[s[1]].append(s)
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for s in into[j]:
                if top[s[0]] + score[s] > top[j]:
                    top[j], back[j] = top[s[0]] + score[s], s
        out, j = [], n
        while j > 0:
            if back[j]:
                out.append(back[j])
                j = back[j][0]
            else:
                j -= 1
        return out

    def fit(self, texts: list[str]) -> Field:
        """Stochastic gradient steps on the log likelihood of the marked sample, island by island."""
        cases = []
        for text in texts:
            gold = base_spans(text)
            gold += [(*trimmed(text, m.start(), m.end()), "secret") for m in SECRET.finditer(text)]
            for tokens in islands(text):
                feats, _ = self.lattice(text, tokens)
                true = set()
                for i, j in feats:
                    span = trimmed(text, tokens[i][0], tokens[j - 1][1])
                    true |= {(i, j, k) for a, b, k in gold if (k == "secret" and covers(text, tokens, i, j, a, b)) or (a, b) == span or (k in ("phone", "card") and trimmed(text, a, b) == span)}
                cases.append((len(tokens), feats, true))
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch / 4)
            for n, feats, true in cases:
                score = {(i, j, k): sum(self.w[k, x] for x in f) for (i, j), f in feats.items() for k in KINDS}
                for (i, j, k), p in self.marginals(n, score).items():
                    step = rate * (((i, j, k) in true) - p)
                    if abs(step) > 1e-4:
                        for x in feats[i, j]:
                            self.w[k, x] += step - rate * RIDGE * self.w[k, x]
        return self

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Base spans and those that the field adds clear of them."""
        out = list(base)
        taken, done = sorted((a, b) for a, b, _ in base), 0
        for tokens in islands(text):
            _, score = self.lattice(text, tokens)
            found = self.best(len(tokens), score)
            if not found:
                continue
            chance = self.marginals(len(tokens), score)
            for i, j, k in sorted(found):
                a, b = trimmed(text, tokens[i][0], tokens[j - 1][1])
                near = [s for s in taken if s[0] < b and a < s[1]] if len(taken) < 50 else overlapping(taken, a, b)
                if b > a >= done and not near and chance[i, j, k] >= SURE:  # an island's last tokens may begin the next one
                    if k == "secret" and b - tokens[j - 1][0] == TOKEN_CHARS:
                        b = whole(text, a, b, taken)
                    out.append((a, b, k))
                    done = b
        return out


def whole(text: str, a: int, b: int, taken: list[tuple[int, int]]) -> int:
    """Where a secret ends whose last token was cut at ``b``: however long it is, but before the next base span."""
    at = bisect_left(taken, (b, 0))
    end = min([TAIL.match(text, b).end(), *(s[0] for s in taken[at:at + 1])])
    return trimmed(text, b, end)[1] if end > b else b


def overlapping(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """Of sorted spans those that meet a to b. Spans of one kind are apart, so few reach over a."""
    at = bisect_left(taken, (b, 0))
    return [s for s in taken[max(0, at - 2 * len(KINDS)):at] if s[1] > a]


def train(docs: DataFrame) -> dict[tuple[str, str], float]:
    """Weights of the field, from about FIT_ROWS whole texts with a signal, drawn by the hash of their id; no labels.

    The draw is a share of the ids, cut to the first FIT_ROWS on Spark: a task
    sends no more, also where one id has very many rows.
    """
    rows = id_text(docs).where(F.col("text").rlike(SIGNAL.pattern))
    share = FIT_ROWS / max(rows.count(), 1)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    got = rows.where(draw < share).select(draw.alias("draw"), "text").orderBy("draw", "text").limit(FIT_ROWS).collect()
    return dict(Field().fit([r["text"] for r in got]).w)


def finder(weights: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))
        for batch in chunks(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = []
            for t in texts:
                if not t or not SIGNAL.search(t):
                    found.append([])
                    continue
                base = base_spans(t)
                sure = set(base)
                found.append([{"start": a, "end": b, "kind": k, "base": (a, b, k) in sure} for a, b, k in ordered(field.spans(t, base))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "pii"])

    return run


def find(docs: DataFrame, weights: dict) -> DataFrame:
    """``docs`` with ``pii``: its text's spans (start, end, kind, base), code points, end exclusive, in order.

    Null and empty texts have none. Every row stands for itself; a column
    of ``docs`` named pii is replaced. One pass, no shuffle.
    """
    docs = docs.drop("pii")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType())])
    return docs.mapInArrow(finder(weights), T.StructType([*docs.schema.fields, T.StructField("pii", T.ArrayType(span))]))


def masker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``pii`` to rows without it, their spans masked."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        out = []
        for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("pii")).to_pylist()):
            done, parts = 0, []
            for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= done:
                    parts += [text[done:s["start"]], f"<{s['kind'].upper()}>"]
                    done = s["end"]
            out.append(text if not parts else "".join(parts) + text[done:])
        columns = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "pii"]
        yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "pii"])


def masked(found: DataFrame) -> DataFrame:
    """``found`` with every span of its text replaced by its kind in angle brackets; of overlapping spans the first, then the longest stays."""
    return found.mapInArrow(masker, found.drop("pii").schema)


def redacted(docs: DataFrame, weights: dict) -> DataFrame:
    """``masked(find(docs, weights))`` in one Python worker, so that spans don't travel and a task needs one process."""
    docs = docs.drop("pii")
    find_spans = finder(weights)
    return docs.mapInArrow(lambda batches: masker(find_spans(batches)), docs.schema)


def pii_query(docs: DataFrame) -> DataFrame:
    """The contract's columns (counts of base spans by kind, their digest, all spans), and how many secrets and spans there are."""
    found = find(id_text(docs), train(docs)).drop("text")
    base = F.filter("pii", lambda s: s["base"])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("pii")).alias("spans"),
                        F.size(F.filter("pii", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret"), F.size("pii").cast("long").alias("n_spans"))
