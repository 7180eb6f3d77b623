"""Quality rules judged by host.

Every document is measured and tested against hard rules (they reject it) and soft
rules (they only count).  Soft failures are added up per host, and each host's
failure rate is shrunk towards the rate of all hosts with a beta prior fitted to
the hosts by moments, so that a host with few documents is not convicted by chance.
The hosts' verdicts are joined back: in a host convicted on a rule, the documents
that fail that rule are rejected; clean documents of any host stay.

Defined results: a null text has no words (and fails the hard length rule), a null
host is a host of its own, an empty table gives an empty table; repeated rows are
measured one by one.  Lines are equal when identical; windows of words are compared
by 64-bit hashes of their words.  A very long text is measured whole; columns that the rules
do not read are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, by_value, land, mix64

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
HOST_LIMIT = 0.5

#: Soft rules as SQL conditions over the measures.
SOFT_RULES = {
    "symbols": "5 * n_symbols > n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    "duplicate_lines": "n_dup_lines > 3",
}
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window found twice or more."""
    k = len(words) - WINDOW + 1
    if k < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    w = np.zeros(k, dtype=np.uint64)
    for i in range(WINDOW):
        w = w * np.uint64(0x9E3779B97F4A7C15) + mix64(h[i:i + k] + np.uint64(i))
    s = np.sort(w)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(w, twice))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def measure_text(text) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words)


def _measure(batches):
    for b in batches:
        rows = [measure_text(t) for t in b.column(b.num_columns - 1).to_pylist()]
        cols = list(zip(*rows)) if rows else [()] * 5
        names = [f.split()[0] for f in MEASURES.split(", ")]
        out = list(b.columns[:-1]) + [pa.array(c, type=pa.int64()) for c in cols]
        yield pa.RecordBatch.from_arrays(out, names=b.schema.names[:-1] + names)


def measures(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """(doc, host, measures): one row per row of ``docs``."""
    rows = docs.select(F.col(key).alias("_doc"), F.col(host).cast("string").alias("_host"),
                       F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"_doc {kind}, _host string, {MEASURES}")


def host_rates(flagged: DataFrame, rules, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, per rule: shrunk rate and verdict).  One row per host; the prior
    of a rule is four sums over the hosts."""
    per = land(flagged.groupBy(F.col("_host").alias("_h")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(f"_f_{r}").cast("long")).alias(f"_k_{r}") for r in rules]), "hosts")
    sums = per.agg(F.count(F.lit(1)).alias("hosts"), F.sum("_n").alias("n"),
                   F.sum(F.col("_n").cast("double") * F.col("_n")).alias("n2"),
                   *[F.sum(f"_k_{r}").alias(f"k_{r}") for r in rules],
                   *[F.sum(F.col(f"_k_{r}").cast("double") * F.col(f"_k_{r}") / F.col("_n")).alias(f"q_{r}")
                     for r in rules]).first()
    out = [F.col("_h"), F.col("_n")]
    for r in rules:
        a, b = beta_prior(sums["hosts"], sums["n"], sums["n2"], sums[f"k_{r}"], sums[f"q_{r}"])
        rate = (F.col(f"_k_{r}") + F.lit(a)) / (F.col("_n") + F.lit(a + b))
        out += [rate.alias(f"_rate_{r}"), (rate > limit).alias(f"_bad_{r}")]
    return per.select(*out)


def beta_prior(hosts, n, n2, k, q) -> tuple[float, float]:
    """Moments of over-dispersed rates: with m = k / n, the weighted spread
    sum n_h (r_h - m)^2 = q - n m^2 exceeds the binomial part (hosts - 1) m (1 - m)
    by (n - n2 / n) times the variance between hosts."""
    if not n or not hosts:
        return 1.0, 1.0
    m = min(max(k / n, 0.5 / (n + 1)), 1 - 0.5 / (n + 1))
    spread = n - n2 / n
    between = (q - n * m * m - (hosts - 1) * m * (1 - m)) / spread if spread > 0 else 0.0
    floor = m * (1 - m) / 1e6          # precision of the prior: at most about a million documents
    strength = m * (1 - m) / max(between, floor) - 1
    strength = max(strength, 1.0)
    return m * strength, (1 - m) * strength


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
          soft_rules=None, limit: float = HOST_LIMIT) -> DataFrame:
    """(key, host, measures, base_failed, soft_failed, host_failed, kept)."""
    rules = SOFT_RULES if soft_rules is None else soft_rules
    hard = (f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words")
    m = land(measures(docs, key, host, text), "host-measures")
    flagged = m.withColumn("base_failed", F.expr(hard))
    for r, cond in rules.items():
        flagged = flagged.withColumn(f"_f_{r}", F.expr(cond))
    hosts = land(host_rates(flagged, list(rules), limit), "host-verdicts")
    joined = flagged.join(hosts.drop("_n", *[f"_rate_{r}" for r in rules]),
                          F.col("_host").eqNullSafe(F.col("_h")), "left")
    names = list(rules)
    soft = F.filter(F.array(*[F.when(F.col(f"_f_{r}"), F.lit(r)) for r in names]), lambda x: x.isNotNull())
    convicted = F.filter(F.array(*[F.when(F.col(f"_f_{r}") & F.col(f"_bad_{r}"), F.lit(r)) for r in names]),
                         lambda x: x.isNotNull())
    return joined.select(
        F.col("_doc").alias(key), F.col("_host").alias(host), *[f.split()[0] for f in MEASURES.split(", ")],
        "base_failed", soft.alias("soft_failed"), convicted.alias("host_failed"),
        (~F.col("base_failed") & (F.size(convicted) == 0)).alias("kept"))


def op10_host_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                              "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    names = list(SOFT_RULES)
    flags = ", ".join(f"({SOFT_RULES[r]}) AS f_{r}" for r in names)
    sums = ", ".join(f"sum(f_{r}::BIGINT) AS k_{r}" for r in names)
    tot = ", ".join(f"sum(k_{r}) AS tk_{r}, sum(k_{r}::DOUBLE * k_{r} / n) AS q_{r}" for r in names)
    prior = ", ".join(f"least(greatest(tk_{r} / tn, 0.5 / (tn + 1)), 1 - 0.5 / (tn + 1)) AS m_{r}" for r in names)
    between = ", ".join(
        f"greatest(m_{r} * (1 - m_{r}) / greatest(CASE WHEN tn - n2 / tn > 0 THEN (q_{r} - tn * m_{r} * m_{r} - "
        f"(hosts - 1) * m_{r} * (1 - m_{r})) / (tn - n2 / tn) ELSE 0 END, m_{r} * (1 - m_{r}) / 1e6) - 1, 1.0) AS s_{r}"
        for r in names)
    bad = ", ".join(f"(k_{r} + m_{r} * s_{r}) / (n + s_{r}) > {HOST_LIMIT} AS bad_{r}" for r in names)
    convicted = " OR ".join(f"(f_{r} AND bad_{r})" for r in names)
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
x AS (SELECT d.doc_id, source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (SELECT count(l) - count(DISTINCT l) FROM (SELECT unnest(string_split(t, chr(10))) AS l)
              WHERE regexp_matches(l, '[^\x20\x09-\x0D]'))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep USING (doc_id)),
y AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed, {flags} FROM x),
h AS (SELECT source, count(*) AS n, {sums} FROM y GROUP BY source),
s AS (SELECT count(*) AS hosts, sum(n) AS tn, sum(n::DOUBLE * n) AS n2, {tot} FROM h),
m AS (SELECT *, {prior} FROM s),
b AS (SELECT *, {between} FROM m),
v AS (SELECT h.source, {bad} FROM h, b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({convicted}) AS kept
FROM y JOIN v ON y.source IS NOT DISTINCT FROM v.source
"""


SQL = _sql()

by_value(__name__)
