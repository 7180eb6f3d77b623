"""Quality classifier from weak labels.

Heuristic labellers vote on every document: clean, junk, or no opinion.  How often each
one is right is not known; expectation-maximisation estimates it from the votes alone:
for either class, the share of junk votes of each labeller, with the class of a document
hidden.  Votes reach the driver as counts per pattern of votes, at most 3 ** labellers
rows whatever the corpus.  The posterior of the hidden class then labels a bounded
sample of distinct texts (SAMPLE_DOCS, chosen by hash) that trains a logistic scorer on
hashed word shapes, and the scorer judges every document, also those on which no
labeller has an opinion.

Both passes over the corpus are per row, without a shuffle of texts; the weights are an
array of fixed size that travels with the tasks.

Defined results: a null or wordless text gets score 0 and is rejected; repeated rows get
equal scores; a very long text is judged whole, by windows; texts that tie for the last place
of the sample are told apart by their hash; extra columns pass through untouched, and the verdict
takes a name that the input does not use; an empty table gives an empty table (and an
untrained scorer).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, free_name, in_slices, positional

SAMPLE_DOCS = 20_000
#: The sample takes a share of so many hash values; fine enough for any number of rows.
HASH_RANGE = 1 << 40
DIMENSIONS = 1 << 14
#: Word pairs of a window in which variety is measured.
WINDOW = 1000
THRESHOLD = 0.3
EM_ROUNDS = 100
STEPS = 300
#: Texts that a task measures at a time.
ROWS = 256
CLEAN, JUNK, PASS = 1, -1, 0

_SHAPE = bytes(97 if 97 <= c <= 122 or c > 127 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(a+|A+|0+)")
_SYMBOL = b"#*$%&|<>{}[]\\~^=+@_"


def _side(value: float, clean: float, junk: float) -> int:
    """A vote by two limits, whichever side junk is on; between them no opinion."""
    if junk > clean:
        return JUNK if value > junk else CLEAN if value < clean else PASS
    return JUNK if value < junk else CLEAN if value > clean else PASS


class Measures:
    """What labellers and features look at."""

    def __init__(self, text):
        raw = (text or "").encode("utf-8", "surrogatepass")
        self.words = raw.split()
        self.n = len(self.words)
        shaped = raw.translate(_SHAPE)
        self.lower, self.upper, self.digits = shaped.count(b"a"), shaped.count(b"A"), shaped.count(b"0")
        self.letters = self.lower + self.upper
        self.shapes = Counter(shaped.split())
        self.solid = sum(len(s) * k for s, k in self.shapes.items())
        self.symbols = sum(map(raw.count, (bytes([c]) for c in _SYMBOL)))
        self.wordless = sum(k for s, k in self.shapes.items() if b"a" not in s and b"A" not in s and b"0" not in s)
        w = self.words
        self.echo = sum(map(bytes.__eq__, w[1:], w))
        # distinct pairs of each window, summed: variety means the same at every length
        self.pairs = sum(len(set(zip(w[i:i + WINDOW], w[i + 1:i + WINDOW + 1]))) for i in range(0, self.n - 1, WINDOW))
        self.loud = sum(k for s, k in self.shapes.items() if s.endswith(b"!!"))


def _no_symbols(m):
    return _side(m.symbols / m.n, 0.1, 0.3) if m.n >= 5 else PASS


def _no_shouting(m):
    return _side(m.upper / m.letters, 0.25, 0.5) if m.letters >= 40 else PASS


def _no_echo(m):
    return _side(m.echo / (m.n - 1), 0.05, 0.2) if m.n >= 10 else PASS


def _varied(m):
    return _side(m.pairs / (m.n - 1), 0.7, 0.5) if m.n >= 20 else PASS


def _real_words(m):
    return _side(m.wordless / m.n, 0.05, 0.2) if m.n >= 5 else PASS


def _mostly_letters(m):
    return _side((m.letters + m.digits) / m.solid, 0.85, 0.7) if m.solid >= 100 else PASS


def _calm(m):
    return _side(m.loud / m.n, 0.02, 0.2) if m.n >= 5 else PASS


LABELLERS = (_no_symbols, _no_shouting, _no_echo, _varied, _real_words, _mostly_letters, _calm)


def votes(m: Measures, labellers=LABELLERS) -> list[int]:
    return [f(m) for f in labellers]


def features(m: Measures) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of unit length: shares of word shapes (letter and digit runs made
    one character) and tenths of repetition and variety."""
    shapes: Counter = Counter()
    for s, k in m.shapes.items():
        shapes[_RUNS.sub(lambda x: x[0][:1], s)[:24]] += k
    if m.n >= 20:
        shapes[b" echo %d" % (10 * m.echo // (m.n - 1))] = m.n
        shapes[b" pairs %d" % (10 * m.pairs // (m.n - 1))] = m.n
    cells: Counter = Counter()
    for s, k in shapes.items():
        cells[zlib.crc32(s) % DIMENSIONS] += (k / max(m.n, 1)) ** 0.5
    at = np.fromiter(cells, dtype=np.int32, count=len(cells))
    v = np.fromiter(cells.values(), dtype=np.float64, count=len(cells))
    return at, v / max(np.linalg.norm(v), 1e-9)


# ---- the label model ----

class LabelModel:
    """P(clean | votes) by EM over (pattern of votes, count)."""

    def __init__(self, patterns: dict[tuple[int, ...], int]):
        rows = sorted(patterns.items())
        self.posterior: dict[tuple[int, ...], float] = {}
        if not rows:
            self.accuracy = np.zeros((2, 0))
            return
        v = np.array([p for p, _ in rows], dtype=np.int64)
        n = np.array([k for _, k in rows], dtype=np.float64)
        cast, junk = (v != PASS).astype(float), (v == JUNK).astype(float)
        clean = np.where(junk.any(axis=1), 0.1, 0.98)           # start: any junk vote is a suspicion
        for _ in range(EM_ROUNDS):
            share = []
            for weight, a, b in ((n * clean, 1.0, 99.0), (n * (1 - clean), 2.0, 2.0)):
                # prior counts: labellers rarely call clean documents junk
                share.append((weight @ junk + a) / (weight @ cast + a + b))
            prior = (n @ clean + 1) / (n.sum() + 2)
            like = [np.exp(junk @ np.log(s) + (cast - junk) @ np.log1p(-s)) for s in share]
            clean = prior * like[0] / (prior * like[0] + (1 - prior) * like[1])
        self.accuracy = np.stack([1 - share[0], share[1]])      # right on clean, right on junk
        self.posterior = {p: float(c) for (p, _), c in zip(rows, clean)}


def train(sample: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Logistic weights (the last one is the intercept) on soft labels, by Adam on the
    whole sample; classes weigh equally."""
    w = np.zeros(DIMENSIONS + 1)
    if not sample:
        return w
    row = np.repeat(np.arange(len(sample)), [len(a) for a, _, _ in sample])
    at, val = np.concatenate([a for a, _, _ in sample]), np.concatenate([v for _, v, _ in sample])
    y = np.array([p for _, _, p in sample])
    weight = y / max(y.sum(), 1e-9) + (1 - y) / max((1 - y).sum(), 1e-9)
    weight /= weight.sum()
    m, s = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        z = np.bincount(row, val * w[at], minlength=len(y)) + w[-1]
        err = weight * (1 / (1 + np.exp(-z)) - y)
        g = np.append(np.bincount(at, val * err[row], minlength=DIMENSIONS), err.sum()) + 1e-6 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-9)
    return w


# ---- over the corpus ----

def _vote(batches):
    for b in in_slices(batches, ROWS):
        seen = Counter(tuple(votes(Measures(t))) for t in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([",".join(map(str, p)) for p in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            names=["pattern", "n"])


def _sample(batches):
    """(hash, pattern, at, val) of every text, once a task however many rows hold it."""
    seen: set[int] = set()
    for b in in_slices(batches, ROWS):
        hashes, rows = [], []
        for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if h not in seen:
                seen.add(h)
                hashes.append(h)
                rows.append(Measures(t))
        cells = [features(m) for m in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array([",".join(map(str, votes(m))) for m in rows], pa.string()),
             pa.array([a for a, _ in cells], pa.list_(pa.int32())), pa.array([v for _, v in cells], pa.list_(pa.float64()))],
            names=["hash", "pattern", "at", "val"])


def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> tuple[LabelModel, np.ndarray]:
    """The label model over all documents, and the scorer's weights."""
    texts = docs.select(F.col(text).cast("string").alias("t"))
    counted = texts.mapInArrow(_vote, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    parse = lambda p: tuple(map(int, p.split(",")))
    model = LabelModel({parse(r["pattern"]): r["n"] for r in counted})
    total = sum(r["n"] for r in counted)
    share = min(HASH_RANGE, -(-HASH_RANGE * sample_docs // max(total, 1)))
    # the sample is of texts, each of them once, whichever and however many rows hold it:
    # about sample_docs texts at most, by their hash alone
    chosen = texts.select(F.xxhash64("t").alias("hash"), "t").where(F.pmod("hash", F.lit(HASH_RANGE)) < share)
    rows = (chosen.mapInArrow(_sample, "hash long, pattern string, at array<int>, val array<double>").where(F.size("at") > 0)
            .groupBy("hash").agg(F.min(F.struct("pattern", "at", "val")).alias("m")).select("m.*").collect())
    rows.sort(key=lambda r: (r["pattern"], r["at"], r["val"]))
    weights = train([(np.array(r["at"]), np.array(r["val"]), model.posterior[parse(r["pattern"])]) for r in rows])
    return model, weights


def _judge(text_at: int, posterior: dict, weights: np.ndarray):
    def run(batches):
        for b in in_slices(batches, ROWS):
            out = []
            for text in b.column(text_at).to_pylist():
                m = Measures(text)
                at, val = features(m)
                score = float(1 / (1 + np.exp(-(weights[at] @ val + weights[-1])))) if m.n else 0.0
                out.append((m.n, posterior.get(tuple(votes(m)), 0.5), score))
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64())],
                names=[*b.schema.names, "_n", "_posterior", "_score"])
    return run


def judge(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS,
          fitted: tuple[LabelModel, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with ``_quality``: struct(n_words, posterior, score, kept)."""
    model, weights = fitted or fit(docs, text, sample_docs)
    rows, (text_x,) = positional(docs, text)
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields)
    out = rows.mapInArrow(_judge(rows.columns.index(text_x), model.posterior, weights),
                          fields + "_n long, _posterior double, _score double")
    return out.select(*[F.col(x).alias(c) for x, c in zip(rows.columns, docs.columns)], F.struct(
        F.col("_n").alias("n_words"), F.col("_posterior").alias("posterior"), F.col("_score").alias("score"),
        (F.col("_score") >= threshold).alias("kept")).alias(free_name(docs, "_quality")))


def op2_quality_classifier(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", "_quality.*")


by_value(__name__)
