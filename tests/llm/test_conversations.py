"""Prefix trie and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chalkline.llm import conversation_repair, prefix_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, g string, node int, _part string, pos int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, f"x{i}", i, "y", -i) for i, r in enumerate(rows)], SCHEMA).repartition(3)


def ordered(rows, null=""):
    """Conversations in order of turn; equal turns by role and text digest."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, null if r is None else r, null if x is None else x))
    return convs


# ---- op11 ----

def brute_trie(convs):
    """{node: (conv_id, depth, parent's conv_id, n_convs, n_children, n_leaves, saved, ends)}"""
    members = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for node, who in members.items():
        below = [m for m in members if m[:len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(x[:-1] == m for x in members if x)]
        saved = sum((len(members[m]) - 1) * len(WORDS.findall(m[-1][1])) for m in below if m)
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(node)))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves), saved,
                    sha(ends)))
    return sorted(out, key=repr)


def rebuilt(rows):
    convs = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: (y[0] is not None, y[0] or 0, md5(y)))]
             for c, v in ordered(rows).items() if c is not None}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def md5(row):
    return hashlib.md5(f"{len(row[1])}:{row[1]}{row[2]}".encode()).hexdigest()


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_trie_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in range(70):
        for t in range(rng.randrange(0, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", ""])))
    rows += [(200, t, "user", "same words here") for t in range(40)] + [(201, t, "user", "same words here") for t in range(40)]
    rows += [(300, None, None, None), (300, 1, "user", None), (None, 1, "user", "lost"), (301, 1, "user", "x " * 30_000)]
    rows += rows[:9]                                    # repeated rows are turns of their own
    df = frame(spark, rows)
    got = trie_rows(prefix_trie.trie(*prefix_trie.rebuilt(df)))
    assert got == brute_trie(rebuilt(rows))


@pytest.mark.parametrize("block,salts", [(2, 3)])
def test_blocks_and_salts_change_nothing(spark, monkeypatch, block, salts):
    rows = [(c, t, "user", f"turn {t if t < 5 else (t, c % 3)}") for c in range(12) for t in range(3 + c)]
    plain = [trie_rows(prefix_trie.trie(*prefix_trie.grafted(prefix_trie.turn_rows(frame(spark, rows)))))]
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SALTS", salts)
    plain.append(trie_rows(prefix_trie.trie(*prefix_trie.grafted(prefix_trie.turn_rows(frame(spark, rows))))))
    convs = {c: [(r, x) for _, r, x in v] for c, v in ordered(rows).items()}
    assert plain[0] == plain[1] == brute_trie(convs)


def test_trie_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(*prefix_trie.rebuilt(none)).count() == 0


# ---- op13 ----

NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}
CAN_KEEP = {("^", "s"), ("^", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def brute_repair(turns):
    """(turn, role, text) rows in order -> the digest columns, by plain dynamic programming
    over (cost, edits)."""
    seen, faults = set(), []
    for _, r, x in turns:
        words = WORDS.findall(x)
        faults.append("blank" if not words else "duplicate" if (r, x) in seen else
                      "truncated" if words[-1][-1] not in ".!?" else "none")
        seen.add((r, x))
    n, memo = len(turns), {}

    def best(i, q, inserted=0):
        if (i, q, inserted) in memo:
            return memo[i, q, inserted]
        ways = []
        if i == n and q in "^a":
            ways.append((0, "", ()))
        if inserted < 3:
            c, e, out = best(i, NEXT[q], inserted + 1)
            ways.append((3 + c, "I" + e, ((NEXT[q], None),) + out))
        if i < n:
            _, r, x = turns[i]
            c, e, out = best(i + 1, q)
            ways.append((4 + c, "D" + e, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if (q, r[:1]) in CAN_KEEP:
                    c, e, out = best(i + 1, r[0])
                    ways.append((c + extra, "K" + e, (("K", i),) + out))
                c, e, out = best(i + 1, NEXT[q])
                ways.append((c + 3 + extra, "R" + e, ((NEXT[q], i),) + out))
        memo[i, q, inserted] = min(ways, default=(10 ** 9, "", ()))
        return memo[i, q, inserted]

    for i in range(n, -1, -1):
        for q in "^sua":
            best(i, q)
    cost, audit, out = best(0, "^")
    names = {"u": "user", "a": "assistant"}
    text = "\n".join(f"{turns[i][1] if k == 'K' else names[k]}:{'' if i is None else turns[i][2]}" for k, i in out)
    ts = [t for t, _, _ in turns if t is not None]
    initials = [r[:1] for _, r, _ in turns]
    return (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            sha(text))


def in_order(turns):
    return sorted(turns, key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.md5(y[2].encode()).hexdigest()))


def random_conversations(rng, n, longest):
    texts = ["Fine.", "Right?", "cut off", "", "  ", "Yes!  ", "Well. ", "Other."]
    return [(c, t if rng.random() < 0.9 else rng.choice([t, None, 3]), rng.choice(["user", "assistant", "user", "system", "tool", None]),
             rng.choice([None, *texts, f"Turn {t}.", f"Turn {t}."])) for c in range(n) for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("chunk", [2, 128])
def test_repair_matches_brute_force(spark, chunk):
    rng = random.Random(chunk)
    rows = random_conversations(rng, 60, 14) + random_conversations(rng, 2, 40)
    rows += [(500, t, "user", "") for t in range(30)] + [(500, 30, "assistant", "End.")]      # forced deletions
    rows += [(501, t, "user" if t % 2 == 0 else "assistant", f"Long {'x' * 50_000} {t}.") for t in range(5)] + [(None, 1, "user", "Hm.")]
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.Repair(frame(spark, rows), chunk=chunk).summary().collect()}
    want = {c: brute_repair(in_order(v)) for c, v in ordered(rows, " ").items()}
    assert got == want


def test_repaired_rows_alternate(spark):
    rows = random_conversations(random.Random(3), 30, 12)
    out = conversation_repair.Repair(frame(spark, rows), chunk=3).rows().collect()
    convs = defaultdict(list)
    for r in sorted(out, key=lambda r: r["place"]):
        convs[r["conv_id"]].append(r["role"][0])
    assert convs and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in convs.values())


def brute_damage(rows):
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield c, t, "user" if kind == 4 else r, x


def test_op13_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = ordered(brute_damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", sha(""))
    want = {c: brute_repair(in_order(damaged[c])) if c in damaged else empty for c in {r[0] for r in rows}}
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.op13_conversation_repair(spark, SF).collect()}
    assert got == want


def test_repair_of_an_empty_table(spark):
    fixed = conversation_repair.Repair(spark.createDataFrame([], SCHEMA))
    assert fixed.summary().count() == 0 and fixed.rows().count() == 0
    assert fixed.summary().where(F.col("cost") > 0).count() == 0
