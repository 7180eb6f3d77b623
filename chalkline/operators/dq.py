"""Data-quality rules: read from the contract, evaluated by one function.

A rule is a dimension and a SQL condition that a good row fulfils.  Field rules
(required, enum, plain text) follow from the silver contract's fields, rules over
several fields are written there.  A dimension fails where the conjunction of its
conditions is FALSE; an unknown (NULL) outcome passes, except in the strict rule set,
where it fails too.  The same table yields a DataFrame column and SQL text, so there
is one statement of every rule.

Timeliness only informs; uniqueness is the work of ``chalkline.operators.dedup``.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions.text import CONTROL_CHAR_PATTERN
from chalkline.functions.time import iso_to_timestamp
from chalkline.operators import contracts

#: Fixed values (must equal the reference): default clock-skew tolerance and lateness
#: threshold in seconds, and the order in which failed dimensions are listed.
DEFAULT_CLOCK_SKEW_SECONDS = 300
DEFAULT_LATE_THRESHOLD_SECONDS = 600
DIMENSIONS = ("completeness", "validity", "accuracy", "consistency")

REASONS_COLUMN = "_dq_failure_reasons"
SETTINGS = "spark.chalkline.dq."


@dataclass(frozen=True)
class Rule:
    dimension: str
    holds: str


@dataclass(frozen=True)
class DQConfig:
    """``as_of`` is the instant that counts as "now" (ISO text; None: the wall clock)."""
    clock_skew_seconds: int = DEFAULT_CLOCK_SKEW_SECONDS
    late_threshold_seconds: int = DEFAULT_LATE_THRESHOLD_SECONDS
    as_of: str | None = None
    strict: bool = False

    @classmethod
    def from_conf(cls, spark, **overrides) -> "DQConfig":
        """Settings ``spark.chalkline.dq.*`` of the session, then the overrides."""
        readers = {
            "clock_skew_seconds": ("clockSkewSeconds", int),
            "late_threshold_seconds": ("lateThresholdSeconds", int),
            "as_of": ("asOf", str),
            "strict": ("strict", lambda v: v.lower() == "true"),
        }
        found = {field: read(value) for field, (name, read) in readers.items()
                 if (value := spark.conf.get(SETTINGS + name, None))}
        return cls(**{**found, **overrides})


@cache
def rules(strict: bool = False, contract: str = "silver_recentchange") -> tuple[Rule, ...]:
    """All rules of a contract, with {now} and {skew} still open."""
    spec = contracts.load(contract)
    wanted = {"always", "strict"} if strict else {"always"}
    out = []
    for f in spec["fields"]:
        name = f"`{f['name']}`"
        if f.get("required") in wanted:
            out.append(Rule("completeness", f"{name} IS NOT NULL"))
        if "enum" in f:
            values = ", ".join(f"'{v}'" for v in f["enum"])
            out.append(Rule("validity", f"{name} IN ({values})"))
        if f.get("plain_text") in wanted:
            plain = f"NOT {name} RLIKE r'{CONTROL_CHAR_PATTERN}'"
            out.append(Rule("validity", f"{name} IS NULL OR {plain}" if f["nullable"] else plain))
    out += [Rule(r["dimension"], r["holds"]) for r in spec.get("rules", [])]
    return tuple(out)


def reasons_sql(cfg: DQConfig = DQConfig()) -> str:
    """SQL text of the failed dimensions, array<string> in the fixed order."""
    now = "current_timestamp()" if cfg.as_of is None else f"try_to_timestamp('{cfg.as_of}')"
    by_dimension = defaultdict(list)
    for rule in rules(cfg.strict):
        by_dimension[rule.dimension].append(
            f"({rule.holds.format(now=f'unix_seconds({now})', skew=cfg.clock_skew_seconds)})")
    entries = []
    for dimension in DIMENSIONS:
        good = " AND ".join(by_dimension[dimension]) or "TRUE"
        good = f"coalesce({good}, FALSE)" if cfg.strict else f"({good})"
        entries.append(f"CASE WHEN NOT {good} THEN '{dimension}' END")
    return f"array_compact(array({', '.join(entries)}))"


def with_reasons(df: DataFrame, cfg: DQConfig = DQConfig()) -> DataFrame:
    """Adds ``_dq_failure_reasons``; row-wise, also on streams."""
    return df.withColumn(REASONS_COLUMN, F.expr(reasons_sql(cfg)))


def select_sql(source: str, cfg: DQConfig = DQConfig()) -> str:
    """The same as a query over a table or view of flattened rows."""
    return f"SELECT *, {reasons_sql(cfg)} AS {REASONS_COLUMN} FROM {source}"


def with_timeliness(df: DataFrame, cfg: DQConfig = DQConfig()) -> DataFrame:
    """Adds ``_ingestion_latency_seconds`` (arrival minus event time) and
    ``_is_late_arrival``; unknown latency is not late in the strict rule set."""
    latency = F.unix_seconds(iso_to_timestamp(F.col("_ingested_at"))) - F.unix_seconds("meta_dt")
    late = latency > cfg.late_threshold_seconds
    return df.withColumns({"_ingestion_latency_seconds": latency,
                           "_is_late_arrival": F.coalesce(late, F.lit(False)) if cfg.strict else late})


def passed(reasons: str = REASONS_COLUMN) -> Column:
    return F.size(reasons) == 0
