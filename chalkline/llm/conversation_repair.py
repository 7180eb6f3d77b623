"""Repair of conversation structure: cheapest edits by rank-convergence parallel Viterbi.

A conversation should alternate: an optional system turn, then pairs of user and assistant.
Each row is kept, given another role, or deleted, and empty turns may be inserted; a small
automaton over role initials (``(s?(ua)+)?``) says what may follow what.  The cheapest way
is a shortest path over four states, found backwards:

* A conversation is cut into chunks of ``CHUNK`` rows, one short string each, dealt out over
  the cluster.  Every chunk starts from a speculative cost vector.  Fix-up passes hand the
  vector at a chunk's start to the chunk before it and rerun the chunks whose vector differs
  from the one they used by more than a constant, until none does.  (Products of min-plus
  matrices soon have rank one: what lies behind a few sound turns only adds a constant.  A
  stretch of forced deletions passes vectors through and may cost a pass a chunk.)
* With the stitched vectors each chunk traces its least edits for each of the four states in
  which it might be entered; composing these maps over doubling distances tells the state in
  which it is entered.  At every step the ASCII-least edit that keeps the cost least is
  taken: Delete, Insert, Keep, Rerole.

Faults of a row, of which the first counts: blank, duplicate (role and text seen earlier in
the conversation), truncated.  Duplicates are found by the first place of each (role, text),
with partial aggregation.  Texts are moved once, by range; all else works on short codes.

Defined results: null role and text read as one space; a role whose first character is not
s, u or a cannot be kept, nor can an empty role; rows are in order of turn, null first,
equal turns by role and a digest of the text.  A null conversation id is a conversation of
its own.  Very long texts are carried once and never split; repeated rows are duplicates.
Extra columns are ignored whatever their names; an empty table gives empty results.  The
``audit`` of a conversation is one value, as long as the conversation; ``rows`` gives
the same edits a row at a time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, land
from .ranges import joined_sha256, running

CHUNK = 128
SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state that an inserted or reroled turn leads to.
TURN = (USER, USER, ASSISTANT, USER)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Costs of completing a conversation after its last row; also the speculative vector.
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL_PAIRS = ("su", "ua", "au")
CLASSES, FAULTS = "suax", ("none", "truncated", "blank", "duplicate")


def _steps():
    """Code letter -> (initial, must be deleted, cost of staying)."""
    return {chr(65 + 4 * i + j): (c, f in ("blank", "duplicate"), TRUNCATED if f == "truncated" else 0)
            for i, c in enumerate(CLASSES) for j, f in enumerate(FAULTS)}


STEPS = _steps()


# ---- inside tasks ----

def backward(codes: str, after) -> list[tuple]:
    """Cost vectors before each row and after the last; the least of each is 0."""
    out = [tuple(after)]
    for code in reversed(codes):
        initial, must, stay = STEPS[code]
        v = out[-1]
        cost = []
        for q in STATES:
            best = DELETE + v[q]
            if not must:
                best = min(best, REROLE + stay + v[TURN[q]])
                if (q, initial) in KEPT:
                    best = min(best, stay + v[KEPT[q, initial]])
            cost.append(best)
        cost[USER], cost[ASSISTANT] = min(cost[USER], INSERT + cost[ASSISTANT]), min(cost[ASSISTANT], INSERT + cost[USER])
        cost[START], cost[SYSTEM] = (min(cost[q], INSERT + cost[USER]) for q in (START, SYSTEM))
        out.append(tuple(cost))
    out.reverse()
    return out


def settled(v) -> list[int]:
    """A vector up to a constant."""
    least = min(v)
    return [int(x - least) for x in v]


def trace(codes: str, costs: list[tuple], q: int, last: bool) -> tuple[str, str, int, int]:
    """(edits, initials after them with - for a deleted row, state at the end, cost)."""
    edits, initials, total = [], [], 0

    def turn(edit):
        edits.append(edit)
        initials.append("a" if q == USER else "u")
        return TURN[q]

    for i, code in enumerate(codes):
        initial, must, stay = STEPS[code]
        while True:
            here, then = costs[i], costs[i + 1]
            if here[q] == DELETE + then[q]:
                edits.append("D")
                initials.append("-")
                total += DELETE
            elif here[q] == INSERT + here[TURN[q]]:
                q = turn("I")
                total += INSERT
                continue
            elif not must and (q, initial) in KEPT and here[q] == stay + then[KEPT[q, initial]]:
                edits.append("K")
                initials.append(initial)
                total += stay
                q = KEPT[q, initial]
            else:
                q = turn("R")
                total += REROLE + stay
            break
    while last and q not in (START, ASSISTANT):
        q = turn("I")
        total += INSERT
    return "".join(edits), "".join(initials), q, total


def _pass(batches):
    """Reruns the chunks whose vector is another than the one they used."""
    for b in batches:
        rows = b.to_pylist()
        for r in rows:
            given = r.pop("given")
            if r["used"] is None or r["used"] != given:
                r["used"], r["out"] = given, settled(backward(r["codes"], given)[0])
        yield pa.RecordBatch.from_pylist(rows, schema=STATE)


STATE = pa.schema([("g", pa.string()), ("chunk", pa.int64()), ("codes", pa.string()), ("last", pa.bool_()),
                   ("used", pa.list_(pa.int64())), ("out", pa.list_(pa.int64()))])
STATE_DDL = "g string, chunk long, codes string, last boolean, used array<long>, out array<long>"


def _trace_all(batches):
    for b in batches:
        done = []
        for r in b.to_pylist():
            costs = backward(r["codes"], r["used"])
            ways = [trace(r["codes"], costs, q, r["last"]) for q in STATES]
            kinds = [STEPS[c][0] for c in r["codes"]]
            done.append({"g": r["g"], "chunk": r["chunk"], "edits": [w[0] for w in ways], "initials": [w[1] for w in ways],
                         "exits": [w[2] for w in ways], "costs": [w[3] for w in ways], "first": kinds[0], "final": kinds[-1],
                         "illegal": sum(x + y not in LEGAL_PAIRS for x, y in zip(kinds, kinds[1:]))})
        yield pa.RecordBatch.from_pylist(done, schema=TRACED)


TRACED = pa.schema([("g", pa.string()), ("chunk", pa.int64()), ("edits", pa.list_(pa.string())),
                    ("initials", pa.list_(pa.string())), ("exits", pa.list_(pa.int64())), ("costs", pa.list_(pa.int64())),
                    ("first", pa.string()), ("final", pa.string()), ("illegal", pa.int64())])
TRACED_DDL = ("g string, chunk long, edits array<string>, initials array<string>, exits array<long>, costs array<long>, "
              "first string, final string, illegal long")


def _edit_rows(size: int):
    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                pos = r["chunk"] * size
                for i, (e, x) in enumerate(zip(r["audit"], r["initials"])):
                    rows.append({"g": r["g"], "place": (r["chunk"] << 32) + i, "pos": None if e == "I" else pos,
                                 "edit": e, "initial": x})
                    pos += e != "I"
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("g", pa.string()), ("place", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()),
                 ("initial", pa.string())]))
    return run


# ---- Spark ----

def _stitched(chunks: DataFrame) -> DataFrame:
    """Chunks with the cost vector behind them, after as many fix-up passes as it takes."""
    guess = F.array(*[F.lit(x).cast("long") for x in AT_END])
    state = (chunks.withColumns({"used": F.lit(None).cast("array<long>"), "out": F.lit(None).cast("array<long>"),
                                 "given": guess}).mapInArrow(_pass, STATE_DDL))
    state = land(state, "repair-pass")
    while True:
        nxt = state.select(F.col("g").alias("h"), (F.col("chunk") - 1).alias("before"), F.col("out").alias("behind"))
        given = (state.where(~F.col("last")).join(nxt, (F.col("g") == F.col("h")) & (F.col("chunk") == F.col("before")))
                 .select(*state.columns, F.col("behind").alias("given")))
        stale = given.where(F.col("given") != F.col("used"))
        if stale.isEmpty():
            return state
        ends = state.where("last").withColumn("given", F.col("used"))
        state = land(given.unionByName(ends).mapInArrow(_pass, STATE_DDL), "repair-pass")


def _entered(traced: DataFrame) -> DataFrame:
    """(g, chunk, entry): the state in which each chunk is entered, for all but first chunks."""
    maps = traced.select("g", "chunk", F.col("exits").alias("to"))
    most = traced.agg(F.max("chunk")).first()[0] or 0
    hop = 1
    while hop <= most:          # maps of doubling stretches, composed
        back = maps.select(F.col("g").alias("h"), (F.col("chunk") + hop).alias("at"), F.col("to").alias("from"))
        both = F.transform("from", lambda q: F.element_at("to", (q + 1).cast("int")))
        maps = land(maps.join(back, (F.col("g") == F.col("h")) & (F.col("chunk") == F.col("at")), "left")
                    .select("g", "chunk", F.when(F.col("from").isNull(), F.col("to")).otherwise(both).alias("to")),
                    "repair-maps")
        hop *= 2
    return maps.select(F.col("g").alias("h"), (F.col("chunk") + 1).alias("at"), F.element_at("to", 1).alias("entry"))


class Repair:
    """The repair of a table of conversations: ``rows()`` are the repaired conversations,
    ``summary()`` has one row per conversation with faults, cost and audit."""

    def __init__(self, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", chunk: int = CHUNK):
        self.kind, self.chunk = conversations.schema[conv].dataType.simpleString(), chunk
        rows = conversations.select(
            F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("g"), F.col(turn).alias("t"),
            *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(n) for x, n in ((role, "role"), (text, "text"))])
        rows = rows.withColumns({"digest": F.md5(F.col("text").cast("binary")), "one": F.lit(1).cast("long")})
        self.placed = (running(rows, "g", ["t", "role", "digest"], {"one": "upto"})
                       .withColumn("pos", F.col("upto") - 1).drop("upto", "one"))
        self.marks = land(self._marks(), "repair-marks")
        self.chunks = land(self._chunks(), "repair-chunks")
        self.traced = land(self._traced(), "repair-traced")

    def _marks(self) -> DataFrame:
        """(g, pos, t, class, fault) of every row."""
        bare = F.rtrim(F.col("text"), F.lit(SPACES))
        initial = F.substring("role", 1, 1)
        narrow = land(self.placed.select(
            "g", "pos", "t", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("class"),
            (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
            F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "digest").cast("binary")).alias("said")),
            "repair-narrow")
        first = narrow.groupBy("g", "said").agg(F.min("pos").alias("p")).select(F.col("g").alias("h"), "p")
        both = narrow.join(first, (F.col("g") == F.col("h")) & (F.col("pos") == F.col("p")), "left")
        fault = (F.when(F.col("blank"), "blank").when(F.col("p").isNull(), "duplicate")
                 .when(F.col("cut"), "truncated").otherwise("none"))
        return both.select("g", "pos", "t", "class", fault.alias("fault"))

    def _chunks(self) -> DataFrame:
        code = F.lit(65) + 4 * F.expr(f"locate(class, '{CLASSES}') - 1")
        code = code + F.array_position(F.array(*[F.lit(f) for f in FAULTS]), F.col("fault")) - 1
        lettered = self.marks.select("g", "pos", F.expr(f"pos div {self.chunk}").alias("chunk"),
                                     F.chr(code.cast("long")).alias("code"))
        chunks = lettered.groupBy("g", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
        ends = lettered.groupBy("g").agg(F.max("chunk").alias("end")).select(F.col("g").alias("h"), "end")
        flagged = chunks.join(ends, (F.col("g") == F.col("h")) & (F.col("chunk") == F.col("end")), "left")
        return flagged.select("g", "chunk", F.array_join(F.col("rows.code"), "").alias("codes"),
                              F.col("end").isNotNull().alias("last"))

    def _traced(self) -> DataFrame:
        """(g, chunk, audit, initials, cost, illegal, first, final) by the chosen entry state."""
        ways = land(_stitched(self.chunks).mapInArrow(_trace_all, TRACED_DDL), "repair-ways")
        entry = _entered(ways)
        chosen = ways.join(entry, (F.col("g") == F.col("h")) & (F.col("chunk") == F.col("at")), "left")
        pick = (F.coalesce("entry", F.lit(START)) + 1).cast("int")
        return chosen.select("g", "chunk", F.element_at("edits", pick).alias("audit"),
                             F.element_at("initials", pick).alias("initials"), F.element_at("costs", pick).alias("cost"),
                             "illegal", "first", "final")

    def _conv(self):
        return F.nullif(F.col("g"), F.lit("")).cast(self.kind)

    def edits(self) -> DataFrame:
        """(g, place, pos, edit, initial): edits in the order of ``place``; an inserted turn
        has no ``pos``, a deleted one the initial ``-``."""
        return self.traced.select("g", "chunk", "audit", "initials").mapInArrow(
            _edit_rows(self.chunk), "g string, place long, pos long, edit string, initial string")

    def _kept(self) -> DataFrame:
        texts = self.placed.select(F.col("g").alias("h"), F.col("pos").alias("at"), F.col("role").alias("was"), "text")
        rows = self.edits().where("edit <> 'D'").join(
            texts, (F.col("g") == F.col("h")) & (F.col("pos") == F.col("at")), "left")
        given = F.when(F.col("initial") == "u", "user").otherwise("assistant")
        return rows.select("g", "place", F.when(F.col("edit") == "K", F.col("was")).otherwise(given).alias("role"),
                           F.coalesce("text", F.lit("")).alias("text"), "edit")

    def rows(self) -> DataFrame:
        """conv_id, place, role, text, edit: the repaired turns, in the order of ``place``."""
        return self._kept().select(self._conv().alias("conv_id"), "place", "role", "text", "edit")

    def summary(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256
        (of ``role:text`` of the repaired turns, newline-joined)."""
        faults = self.marks.groupBy("g").agg(
            *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in FAULTS[1:]])
        turns = self.marks.where("t IS NOT NULL").select("g", "t").distinct().groupBy("g").agg(
            (F.max("t") - F.min("t") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
        nxt = self.traced.select(F.col("g").alias("h"), (F.col("chunk") - 1).alias("before"), F.col("first").alias("then"))
        seams = self.traced.join(nxt, (F.col("g") == F.col("h")) & (F.col("chunk") == F.col("before")), "left")
        seam = F.when(F.col("then").isNull() | F.concat("final", "then").isin(*LEGAL_PAIRS), 0).otherwise(1)
        paths = seams.groupBy("g").agg(
            F.sum(F.col("illegal") + seam).cast("long").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_sort(F.collect_list(F.struct("chunk", "audit"))).alias("audits"))
        line = self._kept().select("g", "place", F.concat("role", F.lit(":"), "text").alias("line"))
        sha = joined_sha256(line, "g", "place", "line", "\n", "repaired_sha256")
        return (faults.join(turns, "g", "left").join(paths, "g").join(sha, "g", "left").select(
            self._conv().alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
            "illegal", "cost", F.array_join(F.col("audits.audit"), "").alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


#: Fixed values of the damage: what happens to a row by crc32("conv_id:turn") % 20.
KINDS_OF_DAMAGE = 20
DROP, EMPTY, UNSTOP, REPEAT, USURP = range(5)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of stops, repeated or given to the user, by their key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % KINDS_OF_DAMAGE
    role, text = (F.coalesce(x, F.lit(" ")) for x in ("role", "text"))
    text = F.when(F.col("kind") == EMPTY, "").when(F.col("kind") == UNSTOP, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(F.col("kind") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).where(F.col("kind") != DROP)
    return rows.select("conv_id", "turn", F.when(F.col("kind") == USURP, "user").otherwise(role).alias("role"),
                       text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op13_conversation_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    every = conversations.select("conv_id").distinct()
    done = Repair(damaged(conversations)).summary().withColumnRenamed("conv_id", "_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(done, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


by_value(__name__)
