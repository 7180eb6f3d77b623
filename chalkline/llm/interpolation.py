"""Language-model scores by deleted interpolation.

A bigram model mixes three estimates, p(w | u) = l2 c(u w) / c(u) + l1 c(w) / N
+ l0 / (V + 1), with weights that depend on how often the context u was seen: contexts
fall into buckets by octave of c(u).  The weights are learned by expectation-
maximisation on a part of the training documents that the counts leave out; the final
counts cover all training documents.  Every document is one sequence of lower-cased
words and an end token; the end token is also the context of the next first word, so
c(u) is the number of tokens that follow u and the estimates add up to one.

How it spreads: documents are packed into blocks of bounded size, which are landed.
Each block asks for the counts of its distinct words and bigrams, keyed by 64-bit
hashes and cut into equal ranges of the hash; one task per range adds up what all
blocks hold and answers each block.  A frequent bigram is one key per block, whatever
number of documents hold it, so no range is hot; nothing of the vocabulary is
broadcast or sent to the driver.  Only the held-out counts reach the driver, as a
histogram over (bucket, octave eighths of the two ratios), whose size does not depend
on the corpus.

Defined results: a null or wordless text is the end token alone; a null id counts as
the empty id when folds are dealt; repeated rows are scored, and counted, one by one;
without training documents only the uniform part remains; a very long text is counted and
scored whole; weights do not depend on the order of rows, so ties have no say; columns besides
id and text are ignored whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, land, mix64, tasks, words_of

FOLDS = 7
HELD_OUT = 2            # scored only
TUNING = 3              # of the training documents: weights are learned on these
BLOCK_CHARS = 5_000_000
RANGE_TOKENS = 1_200_000
ROUNDS = 40
#: Octave eighths; a count of 0 has its own code.
FINE = 8
NONE = -1
#: The end token's hash: a space is no word.
END = xxhash.xxh64_intdigest(b" ")


# ---- packing ----

def pack(a: np.ndarray) -> bytes:
    """An integer array, byte planes apart, compressed."""
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def rows_of(batch):
    """One row at a time as Python objects: a row is a whole block."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


# ---- blocks ----

def _blocks(batches):
    """(block, docs, folds, lens, tokens, words): token 0 is the end token."""
    ctx = TaskContext.get()
    number = (ctx.partitionId() if ctx else 0) << 32
    docs, folds, lens, tokens, chars, ids = [], [], [], [], 0, {b" ": 0}

    def block():
        words = np.fromiter((END if w == b" " else xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([docs]), pa.array([folds], pa.list_(pa.int32())),
             pa.array([lens], pa.list_(pa.int32())), pa.array([pack(np.concatenate(tokens))], pa.binary()),
             pa.array([pack(words)], pa.binary())], names=["block", "docs", "folds", "lens", "tokens", "words"])

    for b in batches:
        for doc, fold, text in zip(*(c.to_pylist() for c in b.columns)):
            row = [ids.setdefault(w, len(ids)) for w in words_of(text)]
            row.append(0)
            docs.append(doc)
            folds.append(fold)
            lens.append(len(row))
            tokens.append(np.array(row, dtype=np.int32))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield block()
                number += 1
                docs, folds, lens, tokens, chars, ids = [], [], [], [], 0, {b" ": 0}
    if docs:
        yield block()


class Block:
    """The keys of a block: distinct words (kind 1) and distinct bigrams (kind 2)."""

    def __init__(self, folds, lens, tokens, words):
        self.lens = np.array(lens, dtype=np.int64)
        self.tokens = unpack(tokens, np.int32).astype(np.int64)
        self.before = np.concatenate(([0], self.tokens[:-1]))
        h = unpack(words, np.uint64)
        self.fold = np.repeat(np.array(folds, dtype=np.int8), self.lens)
        pairs, self.pair = np.unique(self.before * len(h) + self.tokens, return_inverse=True)
        u, w = pairs // len(h), pairs % len(h)
        self.keys = {1: mix64(h), 2: mix64(mix64(h[u]) * np.uint64(0x9E3779B97F4A7C15) + h[w])}
        self.index = {1: self.tokens, 2: self.pair}

    def cut(self, kind: int, ranges: int):
        """Order of the keys by value, and where each hash range begins in it."""
        order = np.argsort(self.keys[kind])
        step = np.uint64(((1 << 64) - 1) // ranges + 1)
        return order, np.searchsorted(self.keys[kind][order] // step, np.arange(ranges + 1, dtype=np.uint64))

    def held(self, kind: int, which: np.ndarray) -> np.ndarray:
        return np.bincount(self.index[kind][which], minlength=len(self.keys[kind]))


def _requests(ranges: int):
    def run(batches):
        for b in batches:
            for r in rows_of(b):
                x = Block(r["folds"], r["lens"], r["tokens"], r["words"])
                tuning = x.fold == TUNING
                main = ~tuning & (x.fold != HELD_OUT)
                for kind in (1, 2):
                    order, at = x.cut(kind, ranges)
                    keys, n_main, n_tuning = x.keys[kind][order], x.held(kind, main)[order], x.held(kind, tuning)[order]
                    for p in range(ranges):
                        s = slice(at[p], at[p + 1])
                        if at[p] == at[p + 1]:
                            continue
                        gaps = np.diff(keys[s], prepend=np.uint64(0))
                        yield pa.RecordBatch.from_pydict({
                            "kind": pa.array([kind], pa.int32()), "range": pa.array([p], pa.int32()),
                            "block": pa.array([r["block"]], pa.int64()), "keys": [pack(gaps)],
                            "main": [pack(n_main[s])], "tuning": [pack(n_tuning[s])]})
    return run


REQUEST = "kind int, range int, block long, keys binary, main binary, tuning binary"


def _answer(group: pa.Table) -> pa.Table:
    """Totals of one hash range for each block that asked; block -1 has the totals of
    the range's words: distinct and all, in the main part and in all training texts."""
    rows = group.to_pylist()
    keys = [np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    place = place.astype(np.int32)
    main, tuning = (np.bincount(place, np.concatenate([unpack(r[c], np.int64) for r in rows])).astype(np.int64)
                    for c in ("main", "tuning"))
    out, at = [], 0
    for r, k in zip(rows, keys):
        mine = place[at:at + len(k)]
        at += len(k)
        out.append((r["block"], r["kind"], r["range"], pack(main[mine]), pack(tuning[mine])))
    if rows[0]["kind"] == 1:
        every = main + tuning
        sums = [np.count_nonzero(main), main.sum(), np.count_nonzero(every), every.sum()]
        out.append((-1, 1, rows[0]["range"], pack(np.array(sums, dtype=np.int64)), b""))
    cols = list(zip(*out))
    return pa.table({"block": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()),
                     "range": pa.array(cols[2], pa.int32()), "main": pa.array(cols[3], pa.binary()),
                     "tuning": pa.array(cols[4], pa.binary())})


ANSWER = "block long, kind int, range int, main binary, tuning binary"


# ---- counts per block, histogram, scores ----

def fine_log(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, np.rint(FINE * np.log2(np.maximum(c, 1))).astype(np.int64), NONE)


def bucket_of(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per octave of its count."""
    return np.where(c > 0, fine_log(c) // FINE + 1, 0)


def _settle(ranges: int, doc_type: pa.DataType):
    """Joins a block with its answers: training counts of its words and bigrams, and the
    histogram of its tuning tokens under the main counts."""
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        answers = {(r["kind"], r["range"]): r for r in right.to_pylist()}
        out = []
        for r in left.to_pylist():
            x = Block(r["folds"], r["lens"], r["tokens"], r["words"])
            counts = {}
            for kind in (1, 2):
                order, _ = x.cut(kind, ranges)
                mine = [answers[kind, p] for p in range(ranges) if (kind, p) in answers]
                for c in ("main", "tuning"):
                    flat = np.concatenate([unpack(a[c], np.int64) for a in mine])
                    counts[kind, c] = np.empty_like(flat)
                    counts[kind, c][order] = flat
            on = x.fold == TUNING
            cu = counts[1, "main"][x.before[on]]
            cuw, cw = counts[2, "main"][x.pair[on]], counts[1, "main"][x.tokens[on]]
            ratio = np.where(cuw > 0, fine_log(cu) - fine_log(cuw), NONE)
            cells, n = np.unique(np.stack([bucket_of(cu), ratio, fine_log(cw)], axis=1), axis=0, return_counts=True)
            hist = [{"bucket": int(b), "r2": int(r2), "q1": int(q1), "n": int(k)} for (b, r2, q1), k in zip(cells, n)]
            out.append({"block": r["block"], "docs": r["docs"], "folds": r["folds"], "lens": r["lens"],
                        "tokens": r["tokens"], "words": r["words"], "hist": hist,
                        "c1": pack(counts[1, "main"] + counts[1, "tuning"]),
                        "c2": pack(counts[2, "main"] + counts[2, "tuning"])})
        cell = pa.struct([("bucket", pa.int32()), ("r2", pa.int32()), ("q1", pa.int32()), ("n", pa.int64())])
        ints = pa.list_(pa.int32())
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("block", pa.int64()), ("docs", pa.list_(doc_type)), ("folds", ints), ("lens", ints),
            ("tokens", pa.binary()), ("words", pa.binary()), ("hist", pa.list_(cell)), ("c1", pa.binary()), ("c2", pa.binary())]))
    return run


def learn_weights(cells: list[tuple[int, int, int, int]], types: int, tokens: int) -> np.ndarray:
    """EM over (bucket, r2, q1, count): rows of (l2, l1, l0) by bucket."""
    size = 66
    start = np.array([0.4, 0.4, 0.2])
    if not cells:
        return np.tile(start, (size, 1))
    b, r2, q1, n = (np.array(c, dtype=np.float64) for c in zip(*cells))
    b = b.astype(np.int64)
    est = np.stack([np.where(r2 == NONE, 0.0, 2.0 ** (-r2 / FINE)),
                    np.where(q1 == NONE, 0.0, 2.0 ** (q1 / FINE) / max(tokens, 1)),
                    np.full(len(n), 1.0 / (types + 1))], axis=1)

    def rounds(group, weights, prior):
        for _ in range(ROUNDS):
            part = est * weights[group]
            part *= (n / part.sum(axis=1))[:, None]
            total = np.stack([np.bincount(group, part[:, k], minlength=len(weights)) for k in range(3)], axis=1) + prior
            weights = total / total.sum(axis=1, keepdims=True)
        return weights

    pooled = rounds(np.zeros(len(n), dtype=np.int64), start[None, :], 1e-6)[0]
    # a bucket with few tokens leans on the pooled weights, as if it had seen ten more tokens
    return rounds(b, np.tile(pooled, (size, 1)), 10 * np.maximum(pooled, 1e-4))


def _scores(weights, types: int, tokens: int, doc_type: pa.DataType):
    def run(batches):
        for b in batches:
            for r in rows_of(b):
                x = Block(r["folds"], r["lens"], r["tokens"], r["words"])
                c1, c2 = unpack(r["c1"], np.int64), unpack(r["c2"], np.int64)
                cw, cu = c1[x.tokens], c1[x.before]
                mix = weights[bucket_of(c1)][x.before]
                p = (mix[:, 0] * c2[x.pair] / np.maximum(cu, 1) + mix[:, 1] * cw / max(tokens, 1) + mix[:, 2] / (types + 1))
                base = np.log10((cw + 1) / (tokens + types + 1))
                at = np.concatenate(([0], np.cumsum(x.lens)[:-1]))
                total = lambda v: np.add.reduceat(v, at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["docs"], doc_type), pa.array([f == HELD_OUT for f in r["folds"]]), pa.array(x.lens),
                     pa.array(total((cw > 0).astype(np.int64))), pa.array(np.full(len(x.lens), tokens, dtype=np.int64)),
                     pa.array(total(base)), pa.array(total(np.log10(p)))],
                    names=["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    fold = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(F.col(key).alias("doc"), fold.cast("int").alias("fold"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType
    doc_type = pa.int64() if kind.simpleString() == "bigint" else pa.string()
    if doc_type == pa.string():
        rows = rows.withColumn("doc", F.col("doc").cast("string"))
    name = "long" if doc_type == pa.int64() else "string"
    cols = f"block long, docs array<{name}>, folds array<int>, lens array<int>, tokens binary, words binary"
    blocks = land(rows.mapInArrow(_blocks, cols), "lm-blocks")
    total = blocks.select(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    ranges = max(8, -(-total // RANGE_TOKENS))
    spread = tasks(docs)
    answers = (blocks.repartition(spread, "block").mapInArrow(_requests(ranges), REQUEST)
               .groupBy("kind", "range").applyInArrow(_answer, ANSWER))
    answers = land(answers, "lm-answers")
    sums = [unpack(r["main"], np.int64) for r in answers.where("block = -1").select("main").toLocalIterator()]
    main_types, main_tokens, types, tokens = (int(v) for v in (np.sum(sums, axis=0) if sums else (0, 0, 0, 0)))
    settled = (blocks.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block"))
               .applyInArrow(_settle(ranges, doc_type),
                             cols + ", hist array<struct<bucket:int,r2:int,q1:int,n:bigint>>, c1 binary, c2 binary"))
    settled = land(settled, "lm-settled")
    cells = (settled.select(F.inline("hist")).groupBy("bucket", "r2", "q1").agg(F.sum("n")).collect())
    weights = learn_weights([tuple(c) for c in cells], main_types, main_tokens)
    out = settled.drop("hist").repartition(spread, "block").mapInArrow(
        _scores(weights, types, tokens, doc_type),
        f"doc {name}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select(F.col("doc").cast(kind).alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_lm_score(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


by_value(__name__)
