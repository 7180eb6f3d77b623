"""op2 against a plain version: EM over single documents, a dense logistic scorer, every score."""

import math

import numpy as np
import pytest

from chalkline.llm import weak_quality as q

SF = "/root/testdata/sf0.001"


def plain_em(ballots):
    """P(clean) of each document, by EM over documents one by one."""
    clean = [0.1 if q.JUNK in b else 0.98 for b in ballots]
    judges = range(len(ballots[0]))
    for _ in range(q.EM_ROUNDS):
        share = {}
        for kind, a, b in ((1, 1.0, 99.0), (0, 2.0, 2.0)):
            w = [c if kind else 1 - c for c in clean]
            for j in judges:
                junk = sum(x for x, v in zip(w, ballots) if v[j] == q.JUNK)
                cast = sum(x for x, v in zip(w, ballots) if v[j] != q.PASS)
                share[kind, j] = (junk + a) / (cast + a + b)
        prior = (sum(clean) + 1) / (len(ballots) + 2)
        nxt = []
        for v in ballots:
            like = [math.prod(share[k, j] if v[j] == q.JUNK else 1 - share[k, j] for j in judges if v[j] != q.PASS) for k in (1, 0)]
            nxt.append(prior * like[0] / (prior * like[0] + (1 - prior) * like[1]))
        clean = nxt
    return clean


def plain_scorer(x, y):
    """Weights and intercept by full-batch Adam on dense rows, classes of equal weight."""
    weight = y / y.sum() + (1 - y) / (1 - y).sum()
    weight /= weight.sum()
    x = np.hstack([x, np.ones((len(x), 1))])
    w, m, s = (np.zeros(x.shape[1]) for _ in range(3))
    for t in range(1, q.STEPS + 1):
        g = x.T @ (weight * (1 / (1 + np.exp(-(x @ w))) - y)) + 1e-6 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g ** 2
        w = w - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-9)
    return w


def dense(text):
    row = np.zeros(q.DIMENSIONS)
    at, val = q.features(q.Measures(text))
    row[at] = val
    return row


def test_every_score_matches_a_plain_model(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    ballots = [q.votes(q.Measures(docs[i])) for i in ids]
    posterior = dict(zip(ids, plain_em(ballots)))
    texts = {}
    for i in ids:                                   # the scorer learns each distinct text once
        if docs[i] and docs[i].split():
            texts.setdefault(docs[i], i)
    w = plain_scorer(np.array([dense(t) for t in texts]), np.array([posterior[i] for i in texts.values()]))
    got = {r["doc_id"]: r for r in q.op2_quality_classifier(spark, SF).collect()}
    assert set(got) == set(ids)
    for i in ids:
        words = len((docs[i] or "").encode().split())
        score = 1 / (1 + math.exp(-(dense(docs[i]) @ w[:-1] + w[-1]))) if words else 0.0
        assert got[i]["n_words"] == words and got[i]["posterior"] == pytest.approx(posterior[i], abs=1e-9)
        assert got[i]["score"] == pytest.approx(score, abs=1e-6) and got[i]["kept"] == (score >= q.THRESHOLD)
