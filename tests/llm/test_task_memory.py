"""What a task holds of its texts does not grow with the rows of a batch."""

import numpy as np
import pyarrow as pa
import pytest

from chalkline.llm import bpe, common, setjoin, weak_quality

ROWS = 1500
TEXTS = [None if i % 97 == 0 else " ".join(f"w{(i * j) % 61} x{i % 13}" for j in range(i % 23)) for i in range(ROWS)]
IDS = pa.array(range(ROWS), pa.int64())


def _single(run, batch):
    """The rows that a task makes of one row at a time."""
    return [r for i in range(batch.num_rows) for out in run([batch.slice(i, 1)]) for r in out.to_pylist()]


CASES = {
    "profiles": (setjoin._profiles(5, 80), [IDS, pa.array(TEXTS, pa.string()), IDS]),
    "verify": (setjoin._verify(5, 80), [IDS, IDS, pa.array([t or "" for t in TEXTS]), pa.array([t or "" for t in TEXTS[13:] + TEXTS[:13]])]),
    "sample": (weak_quality._sample, [IDS, pa.array(TEXTS, pa.string())]),
    "judge": (weak_quality._judge(1, {}, np.zeros(weak_quality.DIMENSIONS + 1)), [IDS, pa.array(TEXTS, pa.string())]),
}


@pytest.mark.parametrize("name", CASES)
def test_a_large_batch_is_worked_off_in_slices(name):
    run, columns = CASES[name]
    batch = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
    out = list(run([batch, batch.slice(0, 0)]))
    assert max(b.num_rows for b in out) <= 256
    assert [r for b in out for r in b.to_pylist()] == _single(run, batch)


def test_votes_are_counted_over_all_slices():
    total: dict = {}
    outs = list(weak_quality._vote([pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string())], names=["t"])]))
    for b in outs:
        for r in b.to_pylist():
            total[r["pattern"]] = total.get(r["pattern"], 0) + r["n"]
    want: dict = {}
    for t in TEXTS:
        p = ",".join(map(str, weak_quality.votes(weak_quality.Measures(t))))
        want[p] = want.get(p, 0) + 1
    assert total == want and len(outs) > 1


def test_encoded_rows_keep_their_texts():
    many = TEXTS * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(many)), pa.int64()), pa.array(many, pa.string())], names=["c0", "c1"])
    run = bpe._encoder(bpe.default_vocab(), 1, 2)
    out = list(run([batch]))
    assert len(out) > 1 and max(b.num_rows for b in out) <= bpe.SLICE_ROWS
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["c0"], r["c1"]) for r in rows] == list(enumerate(many))
    assert [r["c2"] for r in rows[:40]] == [r["c2"] for r in _single(run, batch.slice(0, 40))]


def test_texts_reach_python_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64()), pa.array([b.num_rows], pa.int64())], names=["bytes", "rows"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    long = spark.range(0, 400, 1, 1).selectExpr("repeat(cast(id as string), 30000) AS text")
    with pytest.raises(ValueError):
        with common.small_batches(spark):
            raise ValueError
    assert spark.conf.get(name) == before
    with common.small_batches(spark):
        seen = common.land(long.mapInArrow(sizes, "bytes long, rows long"), "sizes").collect()
    assert spark.conf.get(name) == before
    assert sum(r["rows"] for r in seen) == 400
    assert max(r["bytes"] for r in seen) <= 2 * common.BATCH_BYTES


@pytest.mark.parametrize("by", ["a", "b"])
def test_pairs_sorted_by_either_text_cut_it_once(monkeypatch, by):
    """Sixty pairs of one text with others: 61 texts are cut into shingles, not 120."""
    cut = []
    words = setjoin.words_of
    monkeypatch.setattr(setjoin, "words_of", lambda text: cut.append(text) or words(text))
    one, others = pa.array([0] * 60, pa.int64()), pa.array(range(1, 61), pa.int64())
    hub, rest = pa.array(["a b c d e f"] * 60), pa.array(["a b c d e f" if i % 2 else f"a b c d e {i}" for i in range(60)])
    columns = [one, others, hub, rest] if by == "a" else [others, one, rest, hub]
    out = list(setjoin._verify(3, 90)([pa.RecordBatch.from_arrays(columns, names=["a", "b", "ta", "tb"])]))
    assert sum(b.num_rows for b in out) == 30
    assert len(cut) == 61


def test_links_do_not_depend_on_the_shares_of_texts(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(40 + i % 3)) + f" t{i // 6}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for shares in (1, 3):
        monkeypatch.setattr(setjoin, "TEXT_SHARES", shares)
        j = setjoin.Join(docs, 3, 80)
        texts = {r["cid"]: r["doc"] for r in j.classes.select("cid", "doc").collect()}
        found.append({frozenset((texts[r["a"]], texts[r["b"]])) for r in j.links().collect()})
    assert found[0] == found[1] and len(found[0]) > 100
