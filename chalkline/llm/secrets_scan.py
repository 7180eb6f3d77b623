"""Secret scan with a trigram inverted index, in DataFrame operations only.

From each rule's regular expression the driver derives a Boolean query: alternatives
of sets of trigrams, one of which every match must contain in full.  The index holds,
for the trigrams that occur in some query, one posting (trigram, document) per
document whose lower-cased text contains it.  Postings are intersected by grouping
them by document and evaluating the queries on the set found; the surviving
(document, rule) pairs are verified with the regular expression itself.  A rule whose
expression has no mandatory trigram scans all texts.

Postings are grouped by document, never by trigram, so a trigram that stands in
every document is no hot key; the index has at most one row per document and query
trigram and holds no text.

Defined results: a null text is the empty text; positions are code points, ends are
exclusive; matches of one rule are leftmost and do not overlap, matches of different
rules may.  Documents with equal ids share their postings (verification decides), so
null and repeated ids are safe; a very long text is scanned whole; extra columns are untouched
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, land, positional

MAX_EXACT = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", least=16, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


# ---- Boolean trigram queries ----

def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _clause(strings) -> list[frozenset]:
    """One of these strings occurs: alternatives of trigram sets, without those that
    another one implies; [] (no constraint) if some string is shorter than a trigram."""
    if not strings or any(len(s) < 3 for s in strings):
        return []
    sets = {trigrams(s) for s in strings}
    return sorted((a for a in sets if not any(b < a for b in sets)), key=sorted)


def _walk(parsed) -> tuple[set[str] | None, list[list[frozenset]]]:
    """(all strings the expression can be, or None; clauses that every match fulfils)."""
    run, clauses, exact = {""}, [], True

    def flush():
        nonlocal run, exact
        if c := _clause(run):
            clauses.append(c)
        run, exact = {""}, False

    for op, arg in parsed:
        options, inner = _item(op, arg)
        if options is not None and len(run) * len(options) <= MAX_EXACT:
            run = {a + b for a, b in product(run, options)}
            continue
        flush()
        if options is not None:
            run = set(options)
        clauses += inner
    if exact:
        return run, []
    flush()
    return None, clauses


def _item(op, arg) -> tuple[set[str] | None, list[list[frozenset]]]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, []
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(c).lower() for _, c in arg}, []
        return None, []
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = arg
        strings, inner = _walk(body)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, []
        if least == 0:
            return None, []
        return None, inner if strings is None else ([c] if (c := _clause(strings)) else [])
    if op is sre.BRANCH:
        found = [_walk(b) for b in arg[1]]
        if all(s is not None for s, _ in found):
            return set().union(*(s for s, _ in found)), []
        # one clause per alternative is enough for a sound query: their union
        sides = [_clause(s) if s is not None else (c[0] if c else []) for s, c in found]
        return None, [[x for side in sides for x in side]] if all(sides) else []
    return None, []


def trigram_query(pattern: str) -> list[list[frozenset]]:
    """Conjunction of clauses; a clause is a list of trigram sets of which one occurs in
    full.  Empty: the expression has no mandatory trigram."""
    strings, clauses = _walk(sre_parser.parse(pattern))
    if strings is not None:
        clauses = [c] if (c := _clause(strings)) else []
    return clauses


def vocabulary(rules) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for s in clause for g in s})


# ---- index, intersection, verification ----

def build_index(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Postings (gram, doc) of the rules' trigrams, landed in the shared folder."""
    folded = docs.select(F.col(key).alias("doc"), F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"))
    held = F.array_compact(F.array(*[F.when(F.contains("t", F.lit(g)), F.lit(g)) for g in vocabulary(rules)])
                           ) if vocabulary(rules) else F.array().cast("array<string>")
    return land(folded.select(F.explode(held).alias("gram"), "doc"), "trigram-postings")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc, kinds): documents whose postings satisfy a rule's query."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}

    def holds(clauses) -> Column:
        whole = F.lit(True)
        for clause in clauses:
            some = F.lit(False)
            for grams in clause:
                all_in = F.lit(True)
                for g in sorted(grams):
                    all_in = all_in & F.array_contains("grams", g)
                some = some | all_in
            whole = whole & some
        return whole

    per_doc = index.groupBy("doc").agg(F.collect_set("gram").alias("grams"))    # at most the query vocabulary
    if not queries:
        return per_doc.select("doc", F.array().cast("array<string>").alias("kinds")).where("false")
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return per_doc.select("doc", kinds.alias("kinds")).where(F.size("kinds") > 0)


SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"


def _spans(body: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches: between matches lie the pieces that split() returns."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(body, pattern, F.lit(0))
    value = F.regexp_extract_all(body, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(body, rule.pattern, -1)
    parts = F.zip_with(F.arrays_zip(found.alias("m"), value.alias("v")), F.slice(gaps, 1, F.size(found)),
                       lambda p, g: F.struct(F.length(g).cast("long").alias("gap"),
                                             F.length(p["m"]).cast("long").alias("len"),
                                             F.length(p["v"]).alias("val")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc, p):
        s, e = acc["at"] + p["gap"], acc["at"] + p["gap"] + p["len"]
        span = F.struct(s.alias("start"), F.lit(rank).alias("rank"), e.alias("end"))
        return F.struct(e.alias("at"), F.when(p["val"] >= rule.least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``_secrets``: array of struct(kind, start, end, base), by start, then
    in the order of the rules."""
    hits = candidates(build_index(docs, rules, text, key), rules).select(F.col("doc").alias("_doc"),
                                                                        F.col("kinds").alias("_kinds"))
    rows, (text_x, key_x) = positional(docs, text, key)
    joined = (rows.withColumn("_body", F.coalesce(F.col(text_x).cast("string"), F.lit("")))
              .join(hits, F.col(key_x).eqNullSafe(F.col("_doc")), "left"))
    none = F.array().cast(SPANS)
    each = []
    for rank, rule in enumerate(rules):
        wanted = (F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False)) if trigram_query(rule.pattern)
                  else F.col("_body").rlike(rule.pattern))
        each.append(F.when(wanted, _spans(F.col("_body"), rule, rank)).otherwise(none))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base = F.array(*[F.lit(r.base) for r in rules])
    found = F.transform(F.array_sort(F.concat(*each)), lambda s: F.struct(
        F.element_at(kinds, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.element_at(base, s["rank"] + 1).alias("base")))
    return joined.select(*[F.col(x).alias(c) for x, c in zip(rows.columns, docs.columns)],
                         found.alias(free_name(docs, "_secrets")))


def op7_secret_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = scan(docs).select("doc_id", "_secrets")
    base = F.filter("_secrets", lambda s: s["base"])
    kinds = F.transform("_secrets", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("_secrets")).alias("spans"))


def _sql() -> str:
    spans = []
    for rank, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        spans.append(f"""
SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {str(r.base).lower()} AS base, s AS start, s + length(m[i]) AS stop
FROM (SELECT doc_id, i, m, v, (list_sum(list_transform(g[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
      FROM (SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {r.group}) AS v,
                         regexp_split_to_array(t, '{p}') AS g FROM d)))
WHERE length(v[i]) >= {r.least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(spans)}),
x AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (base) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN x USING (doc_id)
"""


SQL = _sql()
