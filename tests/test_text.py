import unicodedata

from pyspark.sql import functions as F

from chalkline.functions.text import nfc

CASES = ["Café Müller", "北京市", "مرحبا 🚀", "plain ascii"]


def test_nfc_matches_python_and_is_idempotent(spark):
    rows = [(unicodedata.normalize("NFD", s),) for s in CASES] + [(None,)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(nfc(F.col("t")).alias("n"), nfc(nfc(F.col("t"))).alias("nn")).collect()
    got = [r["n"] for r in out]
    assert got == [unicodedata.normalize("NFC", s) for s in CASES] + [None]
    assert [r["nn"] for r in out] == got


def test_nfc_equals_nfd_after_normalization(spark):
    df = spark.createDataFrame([(unicodedata.normalize("NFC", CASES[0]),
                                 unicodedata.normalize("NFD", CASES[0]))], "a string, b string")
    r = df.select((nfc(F.col("a")) == nfc(F.col("b"))).alias("eq"), (F.col("a") == F.col("b")).alias("raw")).first()
    assert r["eq"] is True and r["raw"] is False
