"""Token-id files: independent zstandard frames with a trailing seek table.

A file is a standard zstandard stream in the seekable layout: frames that each hold
FRAME_IDS little-endian unsigned 32-bit ids, one last frame with the document index,
and a skippable frame that lists every frame's compressed size, raw size and checksum
(the low 32 bits of XXH64 of the raw bytes).  A reader fetches the tail, finds the
frames that hold the wanted documents and decompresses only those, checking each.

Documents are range-partitioned by id, one file per task; a task streams its file to
the shared folder under a name of its own and reports it in one manifest row.  The
manifest is a Spark table, so only files of successful task attempts are ever listed:
a lost executor or a speculative attempt leaves an unlisted file behind, no damage.
Files follow each other by range, so a document's place in the whole stream is the
file's start, a sum over one row per file, plus its place in the file.

Defined results: a null text has only its end id; null document ids come first;
rows equal in id follow each other by a hash of their text; a text of any length is
streamed through its file's frames; an empty table gives files without documents.  Document
ids are integers: an id column of another type is an error, as the format stores 64-bit
integers.  Columns besides id and text are ignored whatever their names.  The folder must be one that pyarrow's file systems open
(file, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import struct
import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_alphabet
from .common import by_value, land, shared_path, tasks

FRAME_IDS = 32_768
LEVEL = 3
CACHE_WORDS = 200_000
#: Texts are encoded in slices of about this many characters: distinct words once a slice.
SLICE_CHARS = 8_000_000
#: Printable ASCII and the composed letters of Latin-1 and Latin Extended-A.
STOPS = ".,;:!?"
LATIN = re.compile("[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F]+")
#: Byte-level vocabularies write a byte that is not printable as another character.
BYTE_CHARS = {byte: char for char, byte in byte_alphabet().items()}
#: Fixed values of the seekable zstandard layout.
SKIPPABLE, FOOTER, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "part int, path string, n_docs long, n_ids long"


def check_of(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FileWriter:
    """Streams ids of consecutive documents into one file."""

    def __init__(self, sink):
        self.sink, self.table, self.pending, self.n_pending = sink, [], [], 0
        self.keys, self.lens, self.n_ids = [], [], 0
        self.pack = zstandard.ZstdCompressor(level=LEVEL)

    def _frame(self, raw: bytes) -> None:
        packed = self.pack.compress(raw)
        self.sink.write(packed)
        self.table.append((len(packed), len(raw), check_of(raw)))

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lens.append(len(ids))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.n_pending += len(ids)
        if self.n_pending >= FRAME_IDS:
            all_ids = np.concatenate(self.pending)
            whole = len(all_ids) // FRAME_IDS * FRAME_IDS
            for i in range(0, whole, FRAME_IDS):
                self._frame(all_ids[i:i + FRAME_IDS].astype("<u4").tobytes())
            self.pending, self.n_pending = [all_ids[whole:]], len(all_ids) - whole

    def close(self) -> None:
        if self.n_pending:
            self._frame(np.concatenate(self.pending).astype("<u4").tobytes())
        known = np.array([k is not None for k in self.keys], dtype=np.uint8)
        keys = np.array([k or 0 for k in self.keys], dtype="<i8")
        self._frame(struct.pack("<Q", len(self.keys)) + known.tobytes() + keys.tobytes()
                    + np.array(self.lens, dtype="<u8").tobytes())
        rows = b"".join(struct.pack("<III", *r) for r in self.table)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(rows) + 9) + rows
                        + struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER))


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER or flags != CHECKSUMS:
            raise ValueError("no seek table")
        rows = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), dtype="<u4").reshape(frames, 3)
        self.packed, self.raw, self.check = (rows[:, i].astype(np.int64) for i in range(3))
        self.offset = np.concatenate(([0], np.cumsum(self.packed)))
        index = self.frame(frames - 1)
        n = struct.unpack_from("<Q", index)[0]
        self.known = np.frombuffer(index, np.uint8, n, 8).astype(bool)
        self.keys = np.frombuffer(index, "<i8", n, 8 + n)
        self.lens = np.frombuffer(index, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.lens)))
        self.held = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(length))

    def frame(self, i: int) -> bytes:
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.offset[i], self.packed[i]),
                                                      max_output_size=int(self.raw[i]))
        if check_of(raw) != self.check[i]:
            raise ValueError(f"frame {i} is damaged")
        return raw

    def ids(self, doc: int) -> bytes:
        """Ids of the doc-th document as little-endian bytes; opens only its frames."""
        lo, hi = int(self.start[doc]), int(self.start[doc + 1])
        out = []
        for f in range(lo // FRAME_IDS, -(-hi // FRAME_IDS)):
            if self.held[0] != f:
                self.held = (f, self.frame(f))
            base = f * FRAME_IDS
            out.append(self.held[1][4 * max(lo - base, 0):4 * (hi - base)])
        return b"".join(out)


def open_folder(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path


def slices(texts, chars: int):
    """(start, end) of consecutive texts with about so many characters together."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class WordEncoder:
    """The tokenizers library behind a cache of words.

    The vocabulary's own cut never joins text across ASCII white space, and its
    normalisation does not either, so a text's ids are those of its words in turn.  A new
    word goes through the library's steps one by one (normaliser, cut, model), which costs
    a third of a whole ``encode`` call.  Where the vocabulary file says that text is composed,
    lower-cased, cut by a pattern and mapped byte by byte, a word of printable ASCII and
    composed Latin letters takes these steps here, with the file's own pattern.
    A word that holds an added token is encoded whole.  Words not seen for long are
    forgotten: the cache is two generations of CACHE_WORDS."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.added = [t["content"] for t in config.get("added_tokens", [])]
        self.cut = self._own_cut(config)
        self.model, self.normal, self.pre = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.words, self.old, self.pieces = {}, {}, {}

    @staticmethod
    def _own_cut(config: dict):
        """The file's pattern, where printable ASCII is lower-cased, cut by it, and no more."""
        steps = (config.get("normalizer") or {}).get("normalizers", [])
        known = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
        cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != known or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            return None
        split, level = cuts
        if (split["behavior"], split["invert"]) != ("Removed", True) or level["add_prefix_space"] or level["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _cut(self, word: str) -> list[str]:
        if self.cut is not None:
            plain = word.isascii()
            small = word.lower()
            if plain and small.isalpha():
                return [small]
            if LATIN.fullmatch(small) and (plain or LATIN.fullmatch(word)):
                base = small.rstrip(STOPS)          # letters, then stops, are two pieces
                parts = ([base, small[len(base):]] if base != small else [small]) if base.isalpha() else self.cut.findall(small)
                return parts if plain else [p.encode().decode("latin-1").translate(BYTE_CHARS) for p in parts]
        if self.normal is not None:
            word = self.normal.normalize_str(word)
        return [p for p, _ in self.pre.pre_tokenize_str(word)] if self.pre is not None else [word]

    def _packed(self, text: str) -> bytes:
        """The ids of a word as little-endian unsigned 32-bit integers (none of an empty one)."""
        if not text:
            return b""
        get, out = self.pieces.get, []
        for piece in self._cut(text):
            ids = get(piece)
            if ids is None:
                found = [t.id for t in self.model.tokenize(piece)]
                ids = self.pieces[piece] = struct.pack(f"<{len(found)}I", *found)
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text.  A batch is cut into words and its distinct words are found on
        Arrow arrays; Python sees a distinct word once, ids are gathered with numpy."""
        if len(self.words) > CACHE_WORDS:
            self.words, self.old = {}, self.words
        if len(self.pieces) > CACHE_WORDS:
            self.pieces = {}
        texts = [t or "" for t in texts]
        added = any(a in t for t in texts for a in self.added)
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = cut.values.dictionary_encode()
        words, old, found = self.words, self.old, []
        for w in coded.dictionary.to_pylist():
            ids = words.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    if added and any(a in w for a in self.added):
                        ids = pack(self.tokenizer.encode(w, add_special_tokens=False).ids)
                    else:
                        ids = self._packed(w)
                words[w] = ids
            found.append(ids)
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        which = coded.indices.to_numpy()
        lens = size[which]
        ends = np.cumsum(lens)
        at = np.repeat((np.cumsum(size) - size)[which] - ends + lens, lens) + np.arange(int(lens.sum()))
        edges = np.concatenate(([0], ends))[cut.offsets.to_numpy()]
        every = flat[at]
        return [every[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: One per worker process: each task unpickles its own copy of this module's functions.
_ENCODERS: dict[str, WordEncoder] = sys.__dict__.setdefault("_chalkline_word_encoders", {})


def _encoder_of(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _writer(vocab_path: str, folder: str, end_id: int):
    def run(batches):
        encoder, writer, part = _encoder_of(vocab_path), None, None
        fs, root = open_folder(folder)
        name = f"ids-{uuid.uuid4().hex}.zst"
        sink = None
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            if writer is None and len(keys):
                part = b.column(2)[0].as_py()
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(posixpath.join(root, name), compression=None)
                writer = FileWriter(sink)
            for lo, hi in slices(texts, SLICE_CHARS):
                for key, ids in zip(keys[lo:hi], encoder.encode(texts[lo:hi])):
                    writer.add(key, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"],
                 "n_docs": pa.array([len(writer.keys)], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})
    return run


def write(docs: DataFrame, vocab_path: str, folder: str, key: str = "doc_id", text: str = "text",
          end_id: int = 1) -> DataFrame:
    """Write the files; returns the landed manifest (part, path, n_docs, n_ids, start)."""
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"document ids must be integers, {key} is {docs.schema[key].dataType.simpleString()}")
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    order = [F.col("_key"), F.xxhash64("_text")]        # many rows of one id still spread over ranges
    ranged = (rows.repartitionByRange(tasks(docs), *order)
              .sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id()))
    files = land(ranged.mapInArrow(_writer(vocab_path, folder, end_id), MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row per file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(wanted):
    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, at = open_folder(path)
                with fs.open_input_file(at) as f:
                    r = FileReader(f)
                    docs = range(len(r.keys)) if wanted is None else \
                        np.flatnonzero(np.isin(r.keys, list(wanted)) & r.known).tolist()
                    for lo in range(0, len(docs), 500):
                        part = docs[lo:lo + 500]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array([int(r.keys[d]) if r.known[d] else None for d in part], pa.int64()),
                            "start": pa.array([int(start + r.start[d]) for d in part], pa.int64()),
                            "n_tokens": pa.array([int(r.lens[d]) for d in part], pa.int64()),
                            "ids": pa.array([r.ids(d) for d in part], pa.binary())})
    return run


def read(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit bytes), of all
    documents or of a short list of wanted ids."""
    n = max(tasks(manifest), 1)
    rows = manifest.select("path", "start").repartition(n)
    return rows.mapInArrow(_reader(wanted), "doc_id long, start long, n_tokens long, ids binary")


def default_vocab() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op6_token_files(spark, sf_dir, vocab_path: str | None = None):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write(docs, vocab_path or default_vocab(), shared_path(spark, "token-files"))
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


by_value(__name__)
