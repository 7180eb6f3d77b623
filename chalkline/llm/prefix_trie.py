"""Trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of first turns.  Peeling descends from the greatest depth: at
every depth the conversations that end there and the nodes that survived from below meet,
equal ones are merged, their aggregates are added up, and the last turn is stripped.

* A prefix is named by sums: every turn is hashed with its position, and running sums of
  128-bit hashes (``ranges.running``) name all prefixes at once, without a task that holds
  a whole conversation.  Stripping a turn subtracts its hash.
* Nodes are grouped by name with partial aggregation, so that a first turn shared by a
  third of all conversations shrinks to a row per task before it is shuffled.
* A run of nodes without a branch or an end in between has the same members throughout.
  Such a *stretch* is peeled in one step, since only its top can meet anything; the descent
  visits the depths at which stretches meet, and a long solitary conversation costs no
  rounds.  What a round leaves is appended to a table in the shared folder; a round reads
  only the part that arrives at its depth.  Rounds are as many as there are distinct
  depths with a branch or an end above other nodes.
* Per-node results are read off the stretches; that join is cut into blocks of depth, and
  the one that fetches the owner of a parent is salted.

Defined results: rows without a conversation id are no member of anything.  Order is by
turn, null first, equal turns by a digest of role and text; null role or text is empty.
Very long texts are hashed and counted, never moved.  Repeated rows are turns of their own.
Extra columns are ignored whatever their names.  An empty table has no node, not even a root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, by_value, land, shared_path
from .ranges import joined_sha256, running

ROOT = "root"
#: Positions in one block of a join on a conversation.
BLOCK = 4096
#: Copies of a parent's row, among which its children are dealt out.
SALTS = 16
SUMS = {f"g{i}": f"s{i}" for i in range(4)}


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(c, k, digest, words): every turn with its place k, from 0, in its conversation."""
    who, said = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("t"),
        F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary")).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"))
    placed = running(land(rows, "trie-turns"), "c", ["t", "digest"], {"one": "upto"})
    return land(placed.select("c", (F.col("upto") - 1).alias("k"), "digest", "words"), "trie-places")


def grafted(turns: DataFrame, anchor: Column | None = None, take: Column | None = None,
            most: int = 0) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``take`` turns (at most ``most``; expressions over ``c``)
    are those of conversation ``anchor``: rows (c, d, length, digest, words) with d from 1,
    and all conversations (c, length).  Without an anchor, conversations as they are."""
    lengths = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    none = F.array().cast("array<struct<k:bigint,digest:string,words:bigint>>")
    if anchor is None:
        take, convs = F.lit(0), lengths.withColumns({"h": F.lit(0).cast("long"), "head": none})
    else:
        heads = (turns.where(F.col("k") < most).groupBy(F.col("c").alias("a"))
                 .agg(F.array_sort(F.collect_list(F.struct("k", "digest", "words"))).alias("head")))
        convs = (lengths.withColumns({"a": anchor, "h": take.cast("long")}).join(heads, "a", "left")
                 .withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), none)))
    convs = land(convs.select("c", "own", "h", "head", F.size("head").cast("long").alias("hn"),
                              (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.size("head")).alias("length")),
                 "trie-conversations")
    blocks = convs.select(F.col("c").alias("cc"), "h", "hn", "length",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(own - 1) div {BLOCK}"))).alias("b"))
    kept = turns.where(F.col("k") >= take)
    own = (kept.join(blocks, (F.col("c") == F.col("cc")) & (F.expr(f"k div {BLOCK}") == F.col("b")))
           .select("c", (F.col("k") - F.col("h") + F.col("hn") + 1).alias("d"), "length", "digest", "words"))
    head = convs.select("c", "length", F.posexplode("head").alias("p", "x")).select(
        "c", (F.col("p") + 1).cast("long").alias("d"), "length", "x.digest", "x.words")
    return own.unionByName(head), convs.select("c", "length")


def _prefixes(rows: DataFrame) -> DataFrame:
    """(c, d, length, words, cum, node, parent) of every prefix of every conversation."""
    salted = F.md5(F.concat_ws(":", F.col("d").cast("string"), "digest"))
    pieces = {f"g{i}": F.conv(F.substring(salted, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    hashed = land(rows.select("c", "d", "length", "words", *[v.alias(k) for k, v in pieces.items()]), "trie-hashed")
    summed = running(hashed, "c", ["d"], {**SUMS, "words": "cum"})
    name = F.md5(F.concat_ws(",", *[F.col(x).cast("string") for x in ("d", *SUMS.values())]))
    stripped = F.md5(F.concat_ws(",", (F.col("d") - 1).cast("string"),
                                 *[(F.col(s) - F.col(g)).cast("string") for g, s in SUMS.items()]))
    return land(summed.select("c", "d", "length", "words", "cum", name.alias("node"),
                              F.when(F.col("d") == 1, F.lit(ROOT)).otherwise(stripped).alias("parent")), "trie-prefixes")


def _stretches(nodes: DataFrame) -> DataFrame:
    """Nodes with the same members, top to bottom, as one row."""
    before = F.col("cum") - F.col("words")
    per = nodes.groupBy("conv_id", "n").agg(
        F.min_by(F.struct("parent", "d", before.alias("before")), "d").alias("top"),
        F.max_by(F.struct("node", "d", "words", before.alias("before")), "d").alias("end"))
    return per.select("conv_id", "n", F.col("top.parent").alias("up"), F.col("top.d").alias("lo"),
                      F.col("top.before").alias("lo_before"), F.col("end.node").alias("node"),
                      F.col("end.d").alias("hi"), F.col("end.before").alias("hi_before"), F.col("end.words").alias("words"))


def _peel(stretches: DataFrame) -> DataFrame:
    """Stretches with (leaves, kids, saved) of the node at their lower end, found from the
    greatest depth upwards."""
    spark = stretches.sparkSession
    parents = stretches.where("up IS NOT NULL").select(F.col("up").alias("node")).distinct()
    inner = land(stretches.join(parents, "node", "left_semi"), "trie-inner")
    own = (F.col("n") - 1) * F.col("words")
    ended = stretches.join(parents, "node", "left_anti").withColumns({
        "leaves": F.lit(1).cast("long"), "kids": F.lit(0).cast("long"), "saved": own})
    path = shared_path(spark, "trie-peeled")

    def strip(merged: DataFrame) -> DataFrame:
        """Down to the depth at which a stretch meets others, its top stripped."""
        return merged.withColumn("meets", F.col("lo") - 1)

    first = strip(ended)
    first.write.partitionBy("meets").parquet(path)
    depths = [r["hi"] for r in inner.select("hi").distinct().orderBy(F.desc("hi")).collect()]
    for depth in depths:        # one number per depth at which anything meets
        peeled = spark.read.schema(first.schema).parquet(path).where(F.col("meets") == depth)
        lifted = F.col("saved") + (F.col("n") - 1) * (F.col("hi_before") - F.col("lo_before"))
        arrived = peeled.groupBy(F.col("up").alias("node")).agg(
            F.sum("leaves").alias("leaves"), F.count(F.lit(1)).alias("kids"), F.sum(lifted).alias("below"))
        merged = (inner.where(F.col("hi") == depth).join(arrived, "node").withColumn("saved", own + F.col("below"))
                  .select(*ended.columns))
        strip(merged).select(*first.columns).write.mode("append").partitionBy("meets").parquet(path)
    return spark.read.schema(first.schema).parquet(path)


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, from the rows and conversations of ``grafted``."""
    prefixes = _prefixes(rows)
    per = prefixes.groupBy("node").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n"), *[
        F.max(x).alias(x) for x in ("d", "parent", "cum", "words")])
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        F.lit(ROOT).alias("node"), "conv_id", "n", zero.alias("d"), F.lit(None).cast("string").alias("parent"),
        zero.alias("cum"), zero.alias("words"))
    nodes = land(per.unionByName(root), "trie-nodes")
    stretches = land(_stretches(nodes), "trie-stretches")
    peeled = _peel(stretches)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    owners = peeled.where("kids > 0").select(F.col("node").alias("p"), F.col("conv_id").alias("up_conv"), salts.alias("salt"))
    named = peeled.join(owners, (F.col("up") == F.col("p"))
                        & (F.pmod(F.xxhash64("node"), F.lit(SALTS)) == F.col("salt")), "left")
    blocks = F.explode(F.sequence(F.expr(f"lo div {BLOCK}"), F.expr(f"hi div {BLOCK}")))
    found = named.select(F.col("conv_id").alias("o"), F.col("n").alias("m"), "lo", "hi", "hi_before", "leaves", "kids",
                         "saved", "up_conv", blocks.alias("b"))
    placed = nodes.join(found, (F.col("conv_id") == F.col("o")) & (F.col("n") == F.col("m"))
                        & (F.expr(f"d div {BLOCK}") == F.col("b")))
    ended = prefixes.where("d = length").select("node", "c").unionByName(
        convs.where("length = 0").select(F.lit(ROOT).alias("node"), "c"))
    ends = joined_sha256(ended.withColumn("id", F.col("c").cast("string")), "node", "c", "id", ",", "ends_sha256")
    return placed.join(ends, "node", "left").select(
        "node", "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("lo"), F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(F.col("d") == F.col("hi"), F.col("kids")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * (F.col("hi_before") - F.col("cum") + F.col("words"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


#: Fixed values of the rebuilt conversations: every twentieth lends its first 0 to 3 turns.
LENDER_EVERY, TAKE_BELOW = 20, 4


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    c = F.col("c")
    return grafted(turn_rows(conversations), c - c % LENDER_EVERY, F.crc32(c.cast("string").cast("binary")) % TAKE_BELOW,
                   TAKE_BELOW - 1)


def op11_prefix_trie(spark, sf_dir):
    return trie(*rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).drop("node")


SQL = rf"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS k,
                  md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
                  len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w
           FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT c, list_prepend(4294967295, flatten(list_transform(string_split(c::VARCHAR, ''),
                  lambda x: list_prepend(ascii(x)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))) AS b
         FROM (SELECT DISTINCT c FROM t)),
convs AS (SELECT c, c - c % 20 AS a, xor(list_reduce(b, lambda s, v: CASE WHEN v >= 0 THEN xor(s, v)
                    ELSE xor(s >> 1, (s & 1) * 3988292384) END), 4294967295) % 4 AS take FROM bits),
r AS (SELECT v.c, t.k, t.h, t.w, 0 AS own FROM convs v JOIN t ON t.c = v.a AND t.k < v.take
      UNION ALL SELECT t.c, t.k, t.h, t.w, 1 FROM convs v JOIN t ON t.c = v.c AND t.k >= v.take),
p AS (SELECT c, row_number() OVER z AS d, w, string_agg(h, ',') OVER z AS node FROM r
      WINDOW z AS (PARTITION BY c ORDER BY own, k ROWS UNBOUNDED PRECEDING)
      UNION ALL SELECT c, 0, 0, '' FROM convs),
n AS (SELECT node, d, min(c) AS conv_id, count(*) AS n, max(w) AS w FROM p GROUP BY node, d),
up AS (SELECT n.node, n.d, q.node AS parent FROM n JOIN p q ON q.c = n.conv_id AND q.d = n.d - 1),
kids AS (SELECT parent AS node, count(*) AS kids FROM up GROUP BY parent),
sub AS (SELECT q.node, sum(CASE WHEN kids.node IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.w) AS saved
        FROM n LEFT JOIN kids ON kids.node = n.node JOIN p q ON q.c = n.conv_id AND q.d <= n.d GROUP BY q.node),
ends AS (SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha
         FROM (SELECT c, max(d) AS d FROM p GROUP BY c) JOIN p USING (c, d) GROUP BY node)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, o.conv_id::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs,
       coalesce(kids.kids, 0)::BIGINT AS n_children, sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens,
       coalesce(ends.sha, sha256('')) AS ends_sha256
FROM n LEFT JOIN up ON up.node = n.node LEFT JOIN n o ON o.node = up.parent LEFT JOIN kids ON kids.node = n.node
     JOIN sub ON sub.node = n.node LEFT JOIN ends ON ends.node = n.node
"""

by_value(__name__)
