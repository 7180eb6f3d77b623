"""Dropping copies hashes whole texts of possible copies only."""

from pyspark.sql import functions as F

from chalkline.llm import exact_dedup


def test_only_rows_of_surviving_groups_are_hashed(spark, make, monkeypatch):
    rows = [(i, f"text {i} " * (i + 1), "a") for i in range(200)]
    rows += [(1000, "twice the same", "a"), (1001, "twice the same", "b"), (1002, "Twice the same", "b"), (None, None, "a")]
    docs, hashed, sha2 = make(rows), spark.sparkContext.accumulator(0), F.sha2

    def counted(col, bits):
        seen = F.udf(lambda t: (hashed.add(1), t)[1], "string")
        return sha2(seen(col), bits)

    monkeypatch.setattr(exact_dedup.F, "sha2", counted)
    left = exact_dedup.drop_copies(docs).collect()
    assert sorted(r["doc_id"] or -1 for r in left) == sorted([-1, *[i or -1 for i in range(200)], 1001, 1002])
    assert {r["source"] for r in left if r["doc_id"] == 1001} == {"b"}
    assert 0 < hashed.value < 20
