"""Every operator on nulls, empty and very long texts, repeated rows, an empty table, and
columns whose names clash with its helpers."""

import pytest

from chalkline.llm import (bpe, exact_dedup, host_rules, interpolation, licenses, mixing, secrets_scan, setjoin,
                           token_files, weak_quality)
from chalkline.llm.common import shared_path
from tests.llm.conftest import LONG, ODD_ROWS

FULL = {
    "mixing": lambda d: mixing.mix(d),
    "quality": lambda d: weak_quality.judge(d, sample_docs=50),
    "bpe": lambda d: bpe.decode(bpe.encode(d, bpe.default_vocab()), bpe.default_vocab()),
    "licenses": lambda d: licenses.scan(d),
    "secrets": lambda d: secrets_scan.scan(d),
    "copies": lambda d: exact_dedup.mark_copies(d),
}
NARROW = {
    "scores": lambda d: interpolation.score(d),
    "near": lambda d: setjoin.near_classes(d, 3, 90),
    "hosts": lambda d: host_rules.judge(d),
    "files": lambda d: token_files.read(token_files.write(d, token_files.default_vocab(), shared_path(d.sparkSession, "t"))),
}


@pytest.mark.parametrize("name", [*FULL, *NARROW])
def test_odd_rows_give_one_row_each(odd, name):
    out = {**FULL, **NARROW}[name](odd)
    assert out.count() == len(ODD_ROWS)
    if name in FULL:
        assert out.columns[:len(odd.columns)] == odd.columns
        assert sorted(map(repr, out.select(*odd.columns).collect())) == sorted(map(repr, odd.collect()))


@pytest.mark.parametrize("name", [*FULL, *NARROW])
def test_empty_table_gives_empty_table(none, name):
    assert {**FULL, **NARROW}[name](none).count() == 0


def test_defined_results(odd):
    scores = {(r["doc_id"], r["n_tokens"]): r for r in interpolation.score(odd).collect()}
    assert scores[1, 1]["score"] < 0 and scores[5, 40_001]["n_tokens"] == 40_001
    near = [(r["doc"], r["n_shingles"], r["component"]) for r in setjoin.near_classes(odd, 3, 90).collect()]
    assert sorted(near, key=repr).count((4, 1, 3)) == 2 and (1, 0, 1) in near and (None, 0, None) in near
    kept = {(r["doc_id"], r["text"]): r["_quality"]["kept"] for r in weak_quality.judge(odd, sample_docs=50).collect()}
    assert kept[None, None] is False and kept[1, ""] is False and kept[2, " \t\n"] is False
    hosts = {(r["doc_id"], r["n_words"]): r["kept"] for r in host_rules.judge(odd).collect()}
    assert hosts[None, 0] is False and hosts[5, 40_000] is True
    ids = {r["doc_id"]: r["decoded"] for r in FULL["bpe"](odd).where("doc_id in (5, 6)").collect()}
    assert ids == {5: LONG, 6: ODD_ROWS[8][1]}


def test_repeated_rows_stay_once(odd):
    left = exact_dedup.drop_copies(odd).collect()
    texts = [r["text"] or "" for r in left]
    assert len(texts) == len(set(texts)) == 7
    assert {r["doc_id"] for r in left if (r["text"] or "") == "one"} == {4}      # the largest id stays
