"""The quality classifier's training sample: of texts, not of rows."""

import numpy as np
from pyspark.sql import functions as F

from chalkline.llm import weak_quality

CLEAN = [f"a calm line number{i} of plain prose with words of its own kind and end{i * 7}" for i in range(150)]
JUNK = [f"#$%& {i} *** {{}} BUY{i} NOW!! ~~~ ==> <<{i}>> ||| ^^^ @@@" for i in range(50)]


def _sampled(spark):
    """A clean text that the hash takes at a share of a tenth, by either modulus."""
    texts = spark.createDataFrame([(f"copied words of text {i} that many rows of the table hold again",) for i in range(2000)], "t string")
    hashed = texts.withColumn("h", F.xxhash64("t"))
    return hashed.where("pmod(h, 1000000) < 100000 AND pmod(h, 1099511627776) < 109951162777").first()["t"]


def _fit(spark, texts):
    # the scan order is the order of the rows; 300 of 2,200 rows are asked for
    return weak_quality.fit(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), sample_docs=300)


def test_copies_of_a_sampled_text_do_not_crowd_out_others(spark):
    copies = [_sampled(spark)] * 2000
    first, w_first = _fit(spark, copies + CLEAN + JUNK)
    last, w_last = _fit(spark, CLEAN + JUNK + copies)
    assert first.posterior == last.posterior
    assert np.array_equal(w_first, w_last)                  # the layout of the table decides nothing
    score = lambda t: (lambda at, v: w_first[at] @ v + w_first[-1])(*weak_quality.features(weak_quality.Measures(t)))
    assert min(map(score, CLEAN)) > 0 > max(map(score, JUNK))


def test_a_copied_text_trains_once(spark):
    chosen = _sampled(spark)
    seen = []
    train, weak_quality.train = weak_quality.train, lambda sample: seen.append(sample) or train(sample)
    try:
        _fit(spark, [chosen] * 2000 + CLEAN + JUNK)
    finally:
        weak_quality.train = train
    at, val = weak_quality.features(weak_quality.Measures(chosen))
    assert sum(np.array_equal(a, at) and np.array_equal(v, val) for a, v, _ in seen[0]) == 1
