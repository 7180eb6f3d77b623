"""Byte-pair encoding by speculating and verifying, and decoding.

A text is cut into words by the vocabulary's own pre-tokenisation.  Each distinct
word of a batch is covered greedily with the longest tokens; that proposal is the
byte-pair encoding exactly when every adjacent pair of tokens is *compatible*, that
is, when merging the two tokens' bytes by rank never joins across their border.
All distinct adjacent pairs of a batch are checked together on arrays.  Only words
with an incompatible pair are merged step by step, lowest rank first.

A pair is compatible if no merge across the border would come first.  The merges
that touch the border on the left side are those of the right spine of the left
token, on the right side those of the left spine of the right token, in ascending
rank.  The check walks both spines backwards in time from the whole tokens: a
border merge of the current two parts is premature if its rank is lower than the
rank of the merge that consumed one of them (equal rank on the left consumer:
the leftmost occurrence goes first, so the left side wins); otherwise the part that
was merged later is taken apart.

The vocabulary file is read on each worker from ``vocab_path``, a parameter.  Special
tokens found in a text stand for themselves, as in the tokenizers library.

Defined results: a null text is the empty text and encodes to no ids; decoding
replaces bytes that are no UTF-8 by U+FFFD; a text of any length is encoded whole (a batch
is worked through in slices); repeated rows each have their result; an empty table gives an
empty table; extra columns pass through, and new columns take names that the input does
not use (a name asked for that is taken is an error).
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_value, free_name, in_slices, last_name

#: Pre-tokenisation of byte-level vocabularies (fixed value of the file format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cut for the standard engine, which is faster: right where a text holds only
#: ASCII and Latin letters, whose classes the two engines agree on.
SPLIT_LATIN = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
BEYOND_LATIN = "[^\x09-\x0d\x20-\x7e\u00c0-\u024f]"
CACHE_WORDS = 400_000
#: Words beyond this many bytes are merged one by one with a heap.
LONG_WORD = 64
NEVER = np.int64(1) << 40


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabulary files: printable bytes stand for
    themselves, the others for code points from 256 in ascending order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class Vocabulary:
    """Tokens as bytes, merges as (left id, right id) -> (rank, id)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = as_bytes(token)
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.byte_id = [0] * 256
        for i in vocab.values():
            if len(self.bytes_of[i]) == 1:
                self.byte_id[self.bytes_of[i][0]] = i
        # rank of the merge that makes a token (single bytes: -1) and its two parts
        self.made = np.full(self.size, -1, dtype=np.int64)
        self.left = np.arange(self.size, dtype=np.int64)
        self.right = np.arange(self.size, dtype=np.int64)
        self.rank: dict[int, int] = {}              # left * size + right -> rank
        result = []                                 # rank -> token
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.rank[i * self.size + j] = rank
            result.append(k)
            if self.made[k] < 0:
                self.made[k], self.left[k], self.right[k] = rank, i, j
        self.result = np.array(result, dtype=np.int64)
        self.byte_ids = np.array(self.byte_id, dtype=np.int64)
        keys = np.fromiter(self.rank, dtype=np.int64, count=len(self.rank))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(self.rank.values(), dtype=np.int64, count=len(keys))[order]
        # the proposal may use only tokens that their own bytes encode to
        self.propose: dict[bytes, int] = {}
        tokens = list(vocab.values())
        for i, ids in zip(tokens, self.exact([self.bytes_of[i] for i in tokens])):
            if ids == [i]:
                self.propose[self.bytes_of[i]] = i
        # leftmost-longest matcher over the proposals, bytes as code points below 256
        self.matcher = ahocorasick.Automaton()
        for b, i in self.propose.items():
            self.matcher.add_word(b.decode("latin-1"), i)
        self.matcher.make_automaton()
        self.cut, self.cut_latin, self.beyond = regex.compile(SPLIT), re.compile(SPLIT_LATIN), re.compile(BEYOND_LATIN)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._forget()

    def _forget(self) -> None:
        """Known words: number, and start and length of their ids in one array.  The
        pre-tokenisation never yields a special token's text as a word, so they share it."""
        self.number = {s: k for k, s in enumerate(self.special)}
        self.flat = np.array(list(self.special.values()), dtype=np.int32)
        self.start = np.arange(len(self.special), dtype=np.int64)
        self.length = np.ones(len(self.special), dtype=np.int64)

    def exact(self, words: list[bytes]) -> list[list[int]]:
        """Byte-pair merging, lowest rank first, leftmost among equals; one merge of
        every word at a time, words of like length together on one array."""
        out: list[list[int]] = [[]] * len(words)
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[k] = self._merge_long([self.byte_id[b] for b in w])
            else:
                groups.setdefault(-(-len(w) // 8) * 8, []).append(k)
        for width, members in groups.items():
            for lo in range(0, len(members), 20_000):
                self._merge_rows(words, members[lo:lo + 20_000], width, out)
        return out

    def _merge_rows(self, words, members, width, out) -> None:
        raw = np.frombuffer(b"".join(words[k].ljust(width, b"\0") for k in members), np.uint8).reshape(-1, width)
        row = np.array(members)
        n = np.array([len(words[k]) for k in members])
        ids = self.byte_ids[raw]
        cols = np.arange(width)
        ranks = self.rank_of(ids[:, :-1], ids[:, 1:])
        ranks[cols[None, :-1] >= n[:, None] - 1] = NEVER
        while len(row):
            i = ranks.argmin(axis=1)                     # the first of equal ranks
            r = ranks[np.arange(len(row)), i]
            done = r == NEVER
            for k, x, m in zip(row[done].tolist(), ids[done].tolist(), n[done].tolist()):
                out[k] = x[:m]
            go = ~done
            row, n, ids, ranks, i, r = row[go], n[go] - 1, ids[go], ranks[go], i[go], r[go]
            if not len(row):
                return
            at = np.arange(len(row))
            ids[at, i] = self.result[r]
            step = cols + (cols > i[:, None])            # what stands behind the merged pair moves up
            ids = np.take_along_axis(ids, np.minimum(step, width - 1), axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(step[:, :-1], width - 2), axis=1)
            left = np.flatnonzero(i > 0)
            ranks[left, i[left] - 1] = self.rank_of(ids[left, i[left] - 1], ids[left, i[left]])
            inner = i + 1 < n
            right = np.flatnonzero(inner)
            ranks[right, i[right]] = self.rank_of(ids[right, i[right]], ids[right, i[right] + 1])
            last = np.flatnonzero(~inner & (i < width - 1))
            ranks[last, i[last]] = NEVER
            ranks[cols[None, :-1] >= n[:, None] - 1] = NEVER

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of candidate merges: n log n for words of any length."""
        n, size, rank = len(ids), self.size, self.rank.get
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(i, j):
            if i >= 0 and j < n and (r := rank(ids[i] * size + ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = int(self.result[r]), False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            offer(i, nxt[i])
            offer(prv[i], i)
        return [t for t, ok in zip(ids, alive) if ok]

    def greedy(self, word: bytes) -> list[int]:
        return [i for _, i in self.matcher.iter_long(word.decode("latin-1"))]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of left and right tokens: may they stand side by side?"""
        ok = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        # ranks of the merges that consume the current left and right part
        eat_a, eat_b = np.full(len(a), NEVER - 1), np.full(len(a), NEVER - 1)
        while len(at):
            border = self.rank_of(a, b)
            # consumed on the left at an equal rank: the left occurrence went first
            bad = (border < eat_a) & (border <= eat_b)
            ok[at[bad]] = False
            made_a, made_b = self.made[a], self.made[b]
            go = ~bad & ((made_a >= 0) | (made_b >= 0))
            at, a, b, eat_a, eat_b = at[go], a[go], b[go], eat_a[go], eat_b[go]
            made_a, made_b = made_a[go], made_b[go]
            # the part made last comes apart; of equal ranks the right one was made last
            undo_a = made_a > made_b
            eat_a, a = np.where(undo_a, made_a, eat_a), np.where(undo_a, self.right[a], a)
            eat_b, b = np.where(undo_a, eat_b, made_b), np.where(undo_a, b, self.left[b])
        return ok

    def learn(self, words) -> None:
        """Encode words that the cache lacks."""
        new = [w for w in words if w not in self.number]
        if not new:
            return
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        found = [self.greedy(b) for b in raw]
        lens, flat = ragged(found)
        owner = np.repeat(np.arange(len(found)), lens)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        kinds, which = np.unique(flat[inner] * np.int64(self.size) + flat[inner + 1], return_inverse=True)
        good = self.compatible(kinds // self.size, kinds % self.size)
        failed = np.unique(owner[inner][~good[which]]).tolist()
        if failed:
            for i, ids in zip(failed, self.exact([raw[i] for i in failed])):
                found[i] = ids
            lens, flat = ragged(found)
        self.number.update(zip(new, range(len(self.start), len(self.start) + len(new))))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(lens) - lens))
        self.length = np.concatenate((self.length, lens))
        self.flat = np.concatenate((self.flat, flat))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids one after another)."""
        if len(self.number) > CACHE_WORDS:
            self._forget()
        cut = [self.cut_words(t) for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        n_words = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(n_words.sum()))
        lens = self.length[words]
        ends = np.cumsum(lens)
        at = np.repeat(self.start[words] - ends + lens, lens) + np.arange(int(lens.sum()))
        edge = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_words)))]
        return np.diff(edge), self.flat[at]

    def cut_words(self, text: str) -> list[str]:
        cut = self.cut if self.beyond.search(text) else self.cut_latin
        if not any(s in text for s in self.special):
            return cut.findall(text)
        parts = self.cut_special.split(text)
        return [w for k, p in enumerate(parts) for w in ([p] if k % 2 else cut.findall(p))]

    def decode(self, ids) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


#: One per worker process: each task unpickles its own copy of this module's functions.
_LOADED: dict[str, Vocabulary] = sys.__dict__.setdefault("_chalkline_vocabularies", {})


def _vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


#: Texts are handled in slices of about this many characters, which bounds a task's memory,
#: and leave their batch so many rows at a time.
SLICE_CHARS = 2_000_000
SLICE_ROWS = 1000


def ragged(lists) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return lens, np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(lens.sum()))


def _slices(values, weight):
    start, total = 0, 0
    for i, v in enumerate(values):
        total += weight(v)
        if total >= SLICE_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(values):
        yield start, len(values)


def _encoder(path: str, text_at: int, ids_at: int):
    def run(batches):
        vocab = _vocabulary(path)
        for b in in_slices(batches, SLICE_ROWS):
            texts = [t or "" for t in b.column(text_at).to_pylist()]
            for lo, hi in _slices(texts, len):
                lens, flat = vocab.encode_batch(texts[lo:hi])
                offsets = np.concatenate(([0], np.cumsum(lens))).astype(np.int32)
                cols = list(b.slice(lo, hi - lo).columns)
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=b.schema.names + [f"c{ids_at}"])
    return run


def _decoder(path: str, ids_at: int):
    def run(batches):
        vocab = _vocabulary(path)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids = part.column(ids_at)
                flat, edges = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
                pieces = list(map(vocab.bytes_of.__getitem__, flat[edges[0]:edges[-1]].tolist()))
                known = ids.is_valid().to_pylist()
                texts = [b"".join(pieces[x - edges[0]:y - edges[0]]).decode("utf-8", "replace") if ok else None
                         for x, y, ok in zip(edges, edges[1:], known)]
                yield pa.RecordBatch.from_arrays(list(part.columns) + [pa.array(texts, type=pa.string())],
                                                 names=part.schema.names + ["decoded"])
    return run


def encode(docs: DataFrame, vocab_path: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """``docs`` with a column of token ids (array<int>): ``ids``, or under a name that the
    input does not use (``free_name``)."""
    ids = _new_column(docs, ids, "ids")
    fn = _encoder(vocab_path, docs.columns.index(text), len(docs.columns))
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return _positional(docs, fn, schema)


def decode(docs: DataFrame, vocab_path: str, ids: str | None = None, text: str | None = None) -> DataFrame:
    """``docs`` with the text of its token ids, by default the column that ``encode`` added,
    as ``decoded`` or a free name like it; null ids give a null text."""
    ids, text = ids or last_name(docs, "ids"), _new_column(docs, text, "decoded")
    fn = _decoder(vocab_path, docs.columns.index(ids))
    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())])
    return _positional(docs, fn, schema)


def _new_column(docs: DataFrame, name: str | None, stem: str) -> str:
    if name is None:
        return free_name(docs, stem)
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {name} already")
    return name


def _positional(docs: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """mapInArrow with columns matched by position, whatever their names are."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = [f"c{i}" for i in range(len(schema.fields))]

    def renamed(batches):
        for b in fn(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=names)

    out = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, schema.fields)])
    return inner.mapInArrow(renamed, out).toDF(*schema.names)


def default_vocab() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` of a text column in one worker: ``docs`` without the texts,
    with (ids, decoded), or free names like them."""
    names = [*[c for c in docs.columns if c != text], free_name(docs, "ids"), free_name(docs, "decoded")]
    kept = [i for i, c in enumerate(docs.columns) if c != text]
    encoded, decoded = _encoder(vocab_path, docs.columns.index(text), len(docs.columns)), _decoder(vocab_path, len(kept))

    def without_text(batches):
        for b in encoded(batches):
            yield b.select([*kept, b.num_columns - 1])

    fields = [docs.schema.fields[i] for i in kept]
    schema = T.StructType([*fields, T.StructField(names[-2], T.ArrayType(T.IntegerType())), T.StructField(names[-1], T.StringType())])
    return _positional(docs, lambda batches: decoded(without_text(batches)), schema)


def digests(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Round trip of every text, reduced to counts and digests."""
    both = round_trip(docs.select(key, text), vocab_path, text)
    return both.select(
        key, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe_roundtrip(spark, sf_dir, vocab_path: str | None = None):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, vocab_path or default_vocab())


by_value(__name__)
