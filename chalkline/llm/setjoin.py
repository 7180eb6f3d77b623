"""N-gram Jaccard join by a size-aware heavy-light split.

A document's set holds the hashes of its distinct n-word shingles; equal sets form a
class and only classes are joined.  Two sets of s and t shingles link when
100 * intersection >= pct * union, that is, when their symmetric difference is at most
D = (100 - pct) (s + t) / (100 + pct).

*Light* sets, up to a boundary, enumerate their subsets of the sizes that an
intersection with a possible partner must have: linked sets share such a subset.
*Heavy* sets scan inverted lists.  A list is keyed by a slice of the set: sizes are cut
into bands, and in a band whose pairs differ in at most D shingles the hash range is cut
into K = D + 1 + E slices, so linked sets agree in E + 1 whole slices at least; slices
that are empty are left out unless a set has more than E of them.  A slice holds several
shingles, so a passage that many documents share makes no long list by itself.  Light
sets whose partners may be heavy stand in the lists too.  The boundary is where the
enumerated subsets would cost more than list entries, over the sizes that occur.

Every list member is compared with a few pivots of the list first; a 512-bit parity
sketch, whose Hamming distance never exceeds the symmetric difference, discards pairs
without losing any, and the texts of the rest are compared word for word.  A large set
would fill such a sketch, so the slices of its band are grouped into windows, each with
a sketch of its own, and a pair that meets in a slice is judged by the window of that
slice: of w slices in a window, d hold a difference and e are empty; w - d - e summed
over the windows is 2 at least if the sets link, so some window with d < w has a slice
in which they meet, and all such windows together have two.  Components
of those links are found, and only lists that still span several components are joined
with themselves, across components.  So a group of near copies costs links in
proportion to its size, and every pair of linked texts ends in one component.

Defined results: a text with fewer than n words is one shingle; a null or wordless
text has an empty set and links with nothing; equal sets always link; rows that repeat
an id belong to the class of their own text; a very long text has all its shingles; columns
besides id and text are ignored (``drop_near_copies`` passes them through) whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import combinations, product
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, discard, in_slices, land, mix64, positional, release, shared_path, shingle_hashes, small_batches, tasks, words_of
from .components import components

SKETCH_BITS = 512
#: Sets up to this size keep their hashes, so that the boundary may lie anywhere below.
LIGHT_MAX = 64
#: Cost of a list entry in enumerated subsets: it is sorted and compared with its list.
LIST_COST = 8
BAND_GROWTH = 1.25
#: Members of a list that all others are compared with first.
PIVOTS = 4
#: List entries are sorted in this many shares, one after the other.
SHARES = 4
#: Pairs are verified by so many shares of their first texts times as many of their second ones.
TEXT_SHARES = 3
#: Lists with more members than this outside their main component are joined by pairs of
#: lists: every member is compared with those, against about K / 2 more entries a member.
LONG = 512
LARGEST = 1 << 32
#: Hashes of words that a task keeps.
KNOWN_WORDS = 50_000
#: Rows that a task profiles, and pairs that it verifies, at a time.
ROWS, PAIRS = 256, 64
#: Set in the keys of subsets, not in those of slices.
SUBSET = np.uint64(1)
#: Slices of a window, to less than twice as many; fewer are one window, the whole set.
WINDOW = 128
#: Most windows of a band; larger sets have more slices in each.
WINDOWS = 256
#: Keys of slices name their window in the bits above the lowest: 0 is the whole set, else
#: 1 + WINDOWS * (band mod 8) + window.  Should two bands of a set agree in that, a pair is
#: judged by either window.
WINDOW_BITS = 12
LOW_BITS = WINDOW_BITS + 1
NAMED = np.uint64((1 << LOW_BITS) - 1)
#: A window's limit that excludes nothing.
ANY = (1 << 31) - 1


# ---- sizes, bands, slices ----

def bands(pct: int) -> list[tuple[int, int, int, int]]:
    """(low, high, K, E) by ascending size."""
    out, low = [], 1
    while low < LARGEST:
        high = max(low + 1, int(low * BAND_GROWTH))
        diff = (100 - pct) * 2 * (high - 1) // (100 + pct)
        empty, k = 0, diff + 1
        for _ in range(8):
            mean = k * (1 - 1 / k) ** low if k > 1 else 0.0
            empty = int(mean + 6 * mean ** 0.5 + 0.5) + 1
            k = diff + 1 + empty
        out.append((low, high, k, empty))
        low = high
    return out


def band_numbers(size: int, pct: int, table, lows) -> range:
    """The band of a set, and the following ones that hold larger partners."""
    return range(bisect_right(lows, size) - 1, bisect_right(lows, 100 * size // pct))


def subset_sizes(size: int, pct: int) -> set[int]:
    """Least intersections of a set with each possible partner's size."""
    out = set()
    for t in range(-(-pct * size // 100), 100 * size // pct + 1):
        need = -(-pct * (size + t) // (100 + pct))
        if need <= min(size, t):
            out.add(need)
    return out


def light_cost(size: int, pct: int) -> int:
    return sum(comb(size, c) for c in subset_sizes(size, pct))


def heavy_cost(size: int, pct: int, table, lows) -> int:
    return LIST_COST * sum(table[i][2] for i in band_numbers(size, pct, table, lows))


def boundary(histogram: dict[int, int], pct: int) -> int:
    """The largest light size: the one of least total cost over the sizes that occur."""
    table = bands(pct)
    lows = [b[0] for b in table]
    sizes = range(1, LIGHT_MAX + 1)
    best, at = None, 0
    for x in range(0, LIGHT_MAX + 1):
        cost = sum(histogram.get(s, 0) * ((light_cost(s, pct) if s <= x else 0)
                                          + (heavy_cost(s, pct, table, lows) if 100 * s // pct > x else 0)) for s in sizes)
        if best is None or cost < best:
            best, at = cost, x
    return at


# ---- per document ----

def window_edges(k: int) -> np.ndarray:
    """The first slices of the windows of a band of k slices, and k."""
    count = min(max(k // WINDOW, 1), WINDOWS)
    return np.arange(count + 1, dtype=np.int64) * k // count


def window_names(band: int, count: int) -> np.ndarray:
    return np.arange(count, dtype=np.int64) + 1 + WINDOWS * (band % 8) if count > 1 else np.zeros(count, np.int64)


def _slice_cuts(hashes: np.ndarray, k: int) -> np.ndarray:
    step = np.uint64(((1 << 64) - 1) // k)
    return np.concatenate(([0], np.searchsorted(hashes, np.arange(1, k, dtype=np.uint64) * step), [len(hashes)]))


def sketches(hashes: np.ndarray, pct: int, table, lows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a sorted set and of each of its windows: the name, the most differences of a pair
    that is judged by it, and the sketch."""
    bit = (mix64(hashes + np.uint64(0x51ED270B)) >> np.uint64(55)).astype(np.int64)
    names, most, cells, at = [np.zeros(1, np.int64)], [np.array([ANY])], [bit], 1
    for i in band_numbers(len(hashes), pct, table, lows) if len(hashes) else ():
        edges = window_edges(table[i][2])
        if len(edges) > 2:
            cuts = _slice_cuts(hashes, table[i][2])[edges]
            cells.append(bit + SKETCH_BITS * (at + np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))))
            names.append(window_names(i, len(edges) - 1))
            most.append(np.diff(edges) - 1)
            at += len(edges) - 1
    odd = (np.bincount(np.concatenate(cells), minlength=at * SKETCH_BITS) & 1).astype(np.uint8)
    return np.concatenate(names), np.concatenate(most), np.packbits(odd).view(np.int64)


def slice_keys(hashes: np.ndarray, pct: int, table, lows) -> np.ndarray:
    """List keys of a sorted set, for its band and those of larger partners."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes), dtype=np.uint64)))
    out = []
    for i in band_numbers(len(hashes), pct, table, lows):
        _, _, k, empty = table[i]
        cuts = _slice_cuts(hashes, k)
        filled = cuts[1:] > cuts[:-1]
        keys = mix64((sums[cuts[1:]] - sums[cuts[:-1]]) + mix64(np.arange(k, dtype=np.uint64) + np.uint64(i << 33)))
        edges = window_edges(k)
        name = np.repeat(window_names(i, len(edges) - 1), np.diff(edges)).astype(np.uint64)
        keys = keys & ~NAMED | name << SUBSET
        out.append(keys if k - np.count_nonzero(filled) >= empty else keys[filled])
    return np.concatenate(out) if out else hashes[:0]


def _profiles(n: int, pct: int):
    def run(batches):
        table, known = bands(pct), {}
        lows = [x[0] for x in table]
        for b in in_slices(batches, ROWS):
            sizes, d1, d2, drawn, smalls, keys = [], [], [], [], [], []
            if len(known) > KNOWN_WORDS:
                known.clear()
            for text in b.column(1).to_pylist():
                ids = []
                for w in words_of(text):
                    h = known.get(w)
                    if h is None:
                        h = known[w] = xxhash.xxh64_intdigest(w)
                    ids.append(h)
                s = np.unique(shingle_hashes(np.array(ids, dtype=np.uint64), n))
                sizes.append(len(s))
                m = mix64(s)
                d1.append(int(m.sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(mix64(m + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                drawn.append(sketches(s, pct, table, lows))
                smalls.append(s.view(np.int64) if 0 < len(s) <= LIGHT_MAX else None)
                keys.append(slice_keys(s, pct, table, lows).view(np.int64) if len(s) else s.view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 _sketch_rows(drawn), pa.array(smalls, longs), pa.array(keys, longs)],
                names=["doc", "tag", "n", "d1", "d2", "sketches", "small", "keys"])
    return run


def _sketch_rows(drawn) -> pa.Array:
    flat = lambda i, kind: pa.array(np.concatenate([x[i] for x in drawn]) if drawn else [], kind)
    words, counts = SKETCH_BITS // 64, [len(x[0]) for x in drawn]
    bits = pa.ListArray.from_arrays(pa.array(np.arange(sum(counts) + 1) * words, pa.int32()), flat(2, pa.int64()))
    rows = pa.StructArray.from_arrays([flat(0, pa.int32()), flat(1, pa.int32()), bits], names=["window", "most", "sketch"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), rows)


def text_tag(text: str) -> Column:
    """Tells apart the texts of rows that repeat an id."""
    return F.xxhash64(F.col(text).cast("string"))


def profiles(docs: DataFrame, n: int, pct: int, text: str, key: str) -> DataFrame:
    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"), text_tag(text).alias("tag"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_profiles(n, pct), f"doc {kind}, tag long, n long, d1 long, d2 long, "
                                              "sketches array<struct<window int, most int, sketch array<long>>>, small array<long>, keys array<long>")


def _share(sig: Column) -> Column:
    return F.pmod(F.shiftright(sig, LOW_BITS), F.lit(SHARES))


def _window(sig: str) -> Column:
    """The window that a list's pairs are judged by."""
    of_slice = F.shiftright(F.col(sig), 1).bitwiseAND(F.lit((1 << WINDOW_BITS) - 1))
    return F.when(F.col(sig).bitwiseAND(F.lit(1)) == 1, F.lit(0)).otherwise(of_slice).cast("int")


def _of_two(x: Column, y: Column) -> Column:
    """The key of two lists, judged by the window of the first."""
    return F.xxhash64(x, y).bitwiseAND(F.lit(-1 << LOW_BITS)).bitwiseOR(x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))


def _of_share(cid: str, share: int) -> Column:
    return F.pmod(F.xxhash64(cid), F.lit(TEXT_SHARES)) == share


def _subsets(pct: int):
    def run(batches):
        for b in batches:
            ids, keys = [], []
            for d1, small in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = mix64(np.array(small, dtype=np.int64).view(np.uint64))
                whole = m.sum(dtype=np.uint64)
                for c in sorted(subset_sizes(len(m), pct)):
                    drop = list(combinations(range(len(m)), len(m) - c))
                    gone = np.array([m[list(d)].sum(dtype=np.uint64) for d in drop], dtype=np.uint64)
                    keys.append((mix64((whole - gone) + mix64(np.array([(1 << 62) + c], dtype=np.uint64))) | SUBSET).view(np.int64))
                    ids += [d1] * len(drop)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(keys) if keys else [], pa.int64())], names=["d1", "sig"])
    return run


def _shared(batches):
    """Sorted (sig, d1) -> (sig, d1, pivots) of the keys that several sets have.  The first
    and the last key of a range may go on in the next one, so they stay in any case."""
    sig, d1, first, held = None, None, True, None         # the run that is open; held: its only member

    def rows(s, d, pivots):
        sizes = np.array([len(p) for p in pivots], dtype=np.int64)
        flat = np.concatenate(pivots) if len(pivots) else np.zeros(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(d, pa.int64()),
                                           pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                                          names=["sig", "d1", "pivots"])

    for b in batches:
        s, d = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(s):
            continue
        before_s, before_d = (s[0] if sig is None else sig), (d[0] if sig is None else d1)
        fresh = np.append(sig is None or s[0] != before_s or d[0] != before_d, (s[1:] != s[:-1]) | (d[1:] != d[:-1]))
        s, d = s[fresh], d[fresh]
        if not len(s):
            continue
        starts = np.flatnonzero(np.append(sig is None or s[0] != sig, s[1:] != s[:-1]))
        out_s, out_d, out_p = [], [], []
        goes_on = len(starts) == 0 or starts[0] > 0       # rows that belong to the open run
        edges = np.append(starts, len(s))
        if goes_on:
            upto = edges[0]
            if held is not None:                          # the open run has its second member
                out_s.append([sig]), out_d.append([held]), out_p.append(d[:1])
                pivot, held = held, None
            out_s.append(s[:upto]), out_d.append(d[:upto]), out_p.extend([np.array([pivot], dtype=np.int64)] * upto)
        elif held is not None and first:
            out_s.append([sig]), out_d.append([held]), out_p.append(np.zeros(0, np.int64))
        if len(starts):
            first = first and sig is None
            lengths = np.diff(edges)
            if first and lengths[0] == 1 and len(starts) > 1:
                out_s.append(s[:1]), out_d.append(d[:1]), out_p.append(np.zeros(0, np.int64))
            for i in np.flatnonzero(lengths > 1):
                x, y = edges[i], edges[i + 1]
                out_s.append(s[x:y]), out_d.append(d[x:y]), out_p.extend([d[x:min(y, x + PIVOTS)]] * (y - x))
            held = int(d[starts[-1]]) if lengths[-1] == 1 else None
            first = first and len(starts) == 1
            pivot = int(d[starts[-1]])
        sig, d1 = int(s[-1]), int(d[-1])
        if out_s:
            yield rows(np.concatenate(out_s), np.concatenate(out_d), out_p)
    if held is not None:
        yield rows([sig], [held], [np.zeros(0, np.int64)])


# ---- candidates and verification ----

def _near(pct: int) -> Column:
    """No pair that links fails this in all windows: sizes, and Hamming distance of the sketches.
    Written out word by word, so that it is compiled."""
    ham = reduce(add, (F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_BITS // 64)))
    return ((100 * F.least("na", "nb") >= pct * F.greatest("na", "nb")) & (ham <= F.col("ma"))
            & (ham * (100 + pct) <= (100 - pct) * (F.col("na") + F.col("nb"))))


def _side(full: DataFrame, x: str, *more: str) -> DataFrame:
    """Members of lists as one side of a pair."""
    return full.select("sig", *more, F.col("cid").alias(x), F.col("size").alias("n" + x), F.col("most").alias("m" + x),
                       F.col("sketch").alias("s" + x))


def _verify(n: int, pct: int):
    def run(batches):
        def shingles(text):
            w = words_of(text)
            return set(zip(*(w[i:] for i in range(min(n, len(w))))))
        held_a = held_b = (None, None)          # pairs come sorted by one of their texts
        for b in in_slices(batches, PAIRS):
            ok = []
            for x, y, tx, ty in zip(*(c.to_pylist() for c in b.columns)):
                if held_a[0] != x:
                    held_a = (x, shingles(tx))
                if held_b[0] != y:
                    held_b = (y, shingles(ty))
                one, other = held_a[1], held_b[1]
                common = len(one & other)
                ok.append(100 * common >= pct * (len(one) + len(other) - common))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(mask)
    return run


class Join:
    """The landed tables of one join: ``docs`` (doc, n, d1, d2), ``classes`` (cid, n, d1,
    d2, doc), ``sketches`` (cid, d1, n, window, most, sketch), ``entries`` (sig, d1, pivots) of lists of two
    members or more, and ``lists`` (sig, cid), the same by class."""

    def __init__(self, docs: DataFrame, n: int, pct: int, text: str = "text", key: str = "doc_id"):
        self.n, self.pct = n, pct
        self.texts = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
        spark, keyed_path = docs.sparkSession, shared_path(docs.sparkSession, "jaccard-keys")
        keyed = profiles(docs, n, pct, text, key)
        with small_batches(spark):
            keyed.write.parquet(keyed_path)     # one pass over the texts; the keys go when the lists stand
        keyed = spark.read.schema(keyed.schema).parquet(keyed_path)
        self.rows = land(keyed.drop("keys"), "jaccard-sets")
        ids = ["n", "d1", "d2"]
        least = F.min(F.struct("doc", "tag"))       # a null id comes first, so it is kept apart below
        self.classes = land(self.rows.where("n > 0").groupBy(*ids)
                            .agg(F.min("doc").alias("label"), least.alias("m"))
                            .select(*ids, "label", "m.doc", "m.tag", F.monotonically_increasing_id().alias("cid")),
                            "jaccard-classes")
        c = self.classes.select("cid", *ids, F.col("doc").alias("first"), F.col("tag").alias("first_tag"))
        same = F.col("doc").eqNullSafe(F.col("first")) & (F.col("tag") == F.col("first_tag"))
        members = land(self.rows.join(c, ids).where(same).select("cid", "d1", "n", "sketches", "small"), "jaccard-members")
        release(docs.sparkSession)
        self.sketches = members.select("cid", "d1", "n", F.explode("sketches").alias("s")).select("cid", "d1", "n", "s.*")
        small = members.where(f"n <= {LIGHT_MAX}")
        counts = {r["n"]: r["count"] for r in small.groupBy("n").count().collect()}      # at most LIGHT_MAX rows
        self.boundary = x = boundary(counts, pct)
        light = small.where(F.col("n") <= x).select("d1", "small").mapInArrow(_subsets(pct), "d1 long, sig long")
        heavy = keyed.where(f"n > 0 AND 100 * n DIV {pct} > {x}")
        parts = []
        for share in range(SHARES):
            entries = (heavy.select(F.explode("keys").alias("sig"), "d1").unionByName(light.select("sig", "d1"))
                       .where(_share(F.col("sig")) == share))
            ranged = entries.repartitionByRange(tasks(docs), "sig", "d1").sortWithinPartitions("sig", "d1")
            parts.append(land(ranged.mapInArrow(_shared, "sig long, d1 long, pivots array<long>"), "jaccard-lists"))
            release(docs.sparkSession)
        discard(spark, keyed_path)
        self.entries = parts[0]
        for part in parts[1:]:
            self.entries = self.entries.unionByName(part)
        # a hash of a set, nearly always its class's alone; should two classes share it, both stand in the list
        self.lists = land(self.entries.select("sig", "d1").join(self.classes.select("d1", "cid"), "d1").select("sig", "cid"),
                          "jaccard-members-of-lists")
        release(docs.sparkSession)

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose texts link."""
        near = land(pairs.select("a", "b").distinct(), "jaccard-near")
        t = self.texts_of(near)
        done = None
        # a share of the first texts meets a share of the second ones at a time, and only those
        # two are dealt out, which bounds the disk
        for x, y in product(range(TEXT_SHARES), repeat=2):
            first, second = _of_share("cid", x), _of_share("cid", y)
            mine = near.where(_of_share("a", x) & _of_share("b", y))
            both = (mine.join(t.where(first).select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
                    .join(t.where(second).select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
            with small_batches(near.sparkSession):
                part = land(both.mapInArrow(_verify(self.n, self.pct), "a long, b long"), "jaccard-links")
            done = part if done is None else done.unionByName(part)
            release(near.sparkSession)
        return done

    def texts_of(self, pairs: DataFrame) -> DataFrame:
        """(cid, text) of the classes in these pairs."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        c = self.classes.join(wanted, "cid", "left_semi").select("cid", F.col("doc").alias("first"), "tag")
        found = self.texts.join(c, F.col("doc").eqNullSafe(F.col("first")) & (text_tag("text") == F.col("tag")))
        texts = land(found.select("cid", "text").dropDuplicates(["cid"]), "jaccard-texts")
        release(texts.sparkSession)
        return texts

    def _sketched(self, lists: DataFrame) -> DataFrame:
        """Members of lists with the size of their set, and limit and sketch of the list's window."""
        s = self.sketches.drop("d1").withColumnsRenamed({"cid": "id", "n": "size", "window": "of"})
        return lists.join(s, (F.col("cid") == F.col("id")) & (_window("sig") == F.col("of"))).drop("id", "of")

    def _with_pivots(self) -> DataFrame:
        """Pairs of a list's member and pivot that may link."""
        pairs = (self.entries.select("d1", F.explode("pivots").alias("p"), _window("sig").alias("window")).where("p <> d1")
                 .select(F.least("p", "d1").alias("da"), F.greatest("p", "d1").alias("db"), "window").distinct())
        for x in "ab":
            pairs = pairs.join(self.sketches.select(F.col("d1").alias("d" + x), "window", F.col("cid").alias(x), F.col("n").alias("n" + x),
                                                    F.col("most").alias("m" + x), F.col("sketch").alias("s" + x)), ["d" + x, "window"])
        return pairs.where(_near(self.pct)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _across(self, labels: DataFrame | None) -> DataFrame:
        """Pairs of one list that may link; with labels only those of different components."""
        if labels is None:
            full = land(self._sketched(self.lists.select("sig", "cid")), "jaccard-open")
            x, y = _side(full, "a"), _side(full, "b").withColumnRenamed("sig", "sig_b")
            hit = x.join(y, (F.col("sig") == F.col("sig_b")) & (F.col("a") < F.col("b")) & _near(self.pct))
            return hit.select("a", "b").distinct()
        labelled = land(self.lists.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                        .select("sig", "cid", F.coalesce("root", "cid").alias("comp")), "jaccard-labelled")
        sides = labelled.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("m"))
        lists = (sides.groupBy("sig").agg((F.sum("m") - F.max("m")).alias("outside"), F.count(F.lit(1)).alias("k"))
                 .where("k > 1").select("sig", "outside"))
        opened = land(labelled.join(lists, "sig"), "jaccard-open")
        sorted_lists = F.array_sort(F.collect_set("sig"))         # at most the slices of one set
        long = (F.col("outside") > LONG) & (F.col("sig").bitwiseAND(F.lit(1)) == 0)
        own = opened.where(long).groupBy("cid", "comp").agg(sorted_lists.alias("sigs"))
        pairs = F.flatten(F.transform("sigs", lambda x, i: F.transform(
            F.slice(F.col("sigs"), i + 2, F.greatest(F.size("sigs") - i - 1, F.lit(0))), lambda y: _of_two(x, y))))
        double = own.select(F.explode(pairs).alias("sig"), "cid", "comp")
        return self._of_two_components(opened.where(~long).select("sig", "cid", "comp").unionByName(double))

    def _of_two_components(self, lists: DataFrame) -> DataFrame:
        """Pairs of one list but two components that may link.  One side of each pair is
        outside the list's main component, so no pair inside that one is formed."""
        full = self._sides(lists)
        x = _side(full.where(~F.col("main")), "a", "comp").withColumnRenamed("comp", "ca")
        y = _side(full, "b", "comp", "main").withColumnsRenamed({"sig": "sig_b", "comp": "cb"})
        hit = x.join(y, (F.col("sig") == F.col("sig_b")) & (F.col("ca") != F.col("cb"))
                     & (F.col("main") | (F.col("a") < F.col("b"))) & _near(self.pct))
        return hit.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _sides(self, lists: DataFrame) -> DataFrame:
        """Members of the lists with two components or more; ``main`` marks those of the
        component that has most members there."""
        sides = lists.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("m"))
        main = sides.groupBy("sig").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count(F.lit(1)).alias("k"))
        return land(self._sketched(lists.join(main.where("k > 1"), "sig"))
                    .select("sig", "cid", "comp", "size", "most", "sketch", (F.col("comp") == F.col("main")).alias("main")), "jaccard-sides")

    def links(self) -> DataFrame:
        """Every link between different classes: (a, b)."""
        return self._checked(self._across(None))

    def component_labels(self) -> DataFrame:
        """(cid, label): label is the smallest document id of the class's component."""
        links = self._checked(self._with_pivots())
        labels = components(links)
        more = self._checked(self._across(labels))
        if not more.isEmpty():
            labels = components(links.unionByName(more))
        joined = self.classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
            "cid", "label", F.coalesce("root", "cid").alias("root"))
        least = joined.groupBy("root").agg(F.min("label").alias("label"))
        return joined.select("cid", "root").join(least, "root").select("cid", "label")


def near_classes(docs: DataFrame, n: int, pct: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (doc, tag, n_shingles, component); tag tells the texts of
    rows with equal ids apart."""
    j = Join(docs, n, pct, text, key)
    labels = land(j.classes.drop("label").join(j.component_labels(), "cid").select("n", "d1", "d2", "label"), "jaccard-labels")
    return j.rows.select("doc", "tag", "n", "d1", "d2").join(labels, ["n", "d1", "d2"], "left").select(
        "doc", "tag", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("label")).alias("component"))


def drop_near_copies(docs: DataFrame, n: int = 5, pct: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id."""
    gone = land(near_classes(docs, n, pct, text, key).where(~F.col("doc").eqNullSafe(F.col("component")))
                .select(F.col("doc").alias("_doc"), F.col("tag").alias("_tag")).distinct(), "near-copies")
    rows, (key_x, text_x) = positional(docs, key, text)
    kept = rows.join(gone, F.col(key_x).eqNullSafe(F.col("_doc")) & (text_tag(text_x) == F.col("_tag")), "left_anti")
    return kept.toDF(*docs.columns)


def op8_ngram_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_classes(docs, n=3, pct=90).select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


by_value(__name__)
