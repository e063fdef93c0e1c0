"""The chain of classifiers and the discriminant against their definitions, computed plainly."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from linkwright.llm import quality_classifier as Q
from linkwright.llm import toxicity as X

CLEAN = "stone river meadow lantern quiet copper orchard window harvest bridge".split()
FOUL = "grolk vexpit snarg".split()


def corpus(n=160, seed=4):
    """(docs, labels): every fourth text has foul words, every third is junk."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(8, 30))]
        toxic, junk = i % 4 == 0, i % 3 == 0
        if toxic:
            words += [rng.choice(FOUL) for _ in range(rng.randint(1, 3))]
        if junk:
            words += ["$$", "7", "BUY", "!"] * rng.randint(1, 3)
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


def tables(spark):
    docs, labels = corpus()
    return docs, labels, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def logistic(a, y, l2):
    """Penalised logistic regression by Newton steps on dense rows; the last weight is the free intercept."""
    a = np.column_stack([a, np.ones(len(a))])
    pen = np.full(a.shape[1], l2)
    pen[-1] = 0
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pen) + 1e-9 * np.eye(len(w))
        w -= np.linalg.solve(h, a.T @ (p - y) + pen * w)
    return w


def predict(a, w):
    return 1 / (1 + np.exp(-(a @ w[:-1] + w[-1])))


def test_chain_by_hand(spark):
    docs, labels, d, m = tables(spark)
    got = {r.doc_id: r for r in X.toxicity_scores(d, m).collect()}

    def counts(text):
        out = Counter()
        for w in re.findall(r"[a-z]+", text.lower()):
            out.update([w, *[f"{n}:{w[:n]}" for n in (4, 5) if len(w) >= n]])
        return out

    each = [counts(t) for _, t in docs]
    seen = Counter(f for c in each for f in c)
    vocabulary = sorted(f for f, n in seen.items() if n >= X.MIN_TEXTS)
    assert len(vocabulary) < X.MAX_FEATURES
    a = np.array([[math.log1p(c[f]) for f in vocabulary] for c in each])
    fold = {r.doc_id: r.f for r in d.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(X.FOLDS)).alias("f")).collect()}
    folds = np.array([fold[i] for i, _ in docs])
    toxic, sound = np.array([t for _, _, t in labels]), np.array([q for _, q, _ in labels])
    train, use = a, a
    for name, y in (("p_toxic_prose", toxic * sound), ("p_toxic_junk", toxic * (1 - sound)), ("p_toxic", toxic)):
        w = logistic(train, y, X.L2)
        p = predict(use, w)
        assert max(abs(p[k] - got[i][name]) for k, (i, _) in enumerate(docs)) < 0.03, name
        held = np.zeros(len(y))
        for f in range(X.FOLDS):
            held[folds == f] = predict(train[folds == f], logistic(train[folds != f], y[folds != f], X.L2))
        squeeze = lambda v: np.log(np.clip(v, 0.018, 0.982) / (1 - np.clip(v, 0.018, 0.982))) / 4
        train, use = np.column_stack([train, squeeze(held)]), np.column_stack([use, squeeze(p)])
    assert all(r.is_toxic == (r.p_toxic >= X.THRESHOLD) for r in got.values())
    assert sum(r.is_toxic == bool(toxic[i]) for i, r in got.items()) >= 0.95 * len(docs)


def test_statistics_by_hand(spark):
    texts = ["Two words, here!", "A1 b2\nA1 b2\n\nc", "", None, "  ", "é È 33 $ ok?"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: dict(zip(Q.FEATURES, r.x, strict=True)) for r in Q.statistics(rows).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        n, chars = max(len(words), 1), max(sum(map(len, words)), 1)
        many = lambda s, t=t: sum(t.count(c) for c in s)
        want = {
            "words": math.log(1 + len(words)), "symbols": math.log(0.005 + many("#*$%&|<>") / chars), "word_length": math.log(1 + sum(map(len, words)) / n),
            "capitals": math.log(0.01 + many("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars), "stops": math.log(0.01 + many(".,;:") / n),
            "shouts": math.log(0.005 + many("!?") / n), "digits": math.log(0.01 + many("0123456789") / chars),
        }
        for k, v in want.items():
            assert abs(got[i][k] - v) < 1e-9, (t, k)


def test_discriminant_by_hand(spark):
    docs, labels, d, m = tables(spark)
    stats = Q.statistics(d).checkpoint()
    x = {r.doc_id: np.array(r.x) for r in stats.collect()}
    from zlib import crc32

    kept = [(i, q) for i, q, _ in labels if crc32(str(i).encode()) % 4 != 2]
    a, y = np.array([x[i] for i, _ in kept]), np.array([q for _, q in kept])
    model = Q.fitted(stats, m)
    scale = np.where(a.std(axis=0) > 1e-9, a.std(axis=0), 1.0)
    z = (a - a.mean(axis=0)) / scale
    dim = z.shape[1]
    cov = {k: sum(np.outer(r, r) for r in z[y == k] - z[y == k].mean(axis=0)) / (y == k).sum() for k in (0, 1)}
    pooled = sum(cov[k] * (y == k).sum() for k in cov) / len(y)
    shrunk = {}
    for k in cov:
        c = (1 - Q.TO_POOLED) * cov[k] + Q.TO_POOLED * pooled
        shrunk[k] = (1 - Q.TO_IDENTITY) * c + Q.TO_IDENTITY * np.trace(c) / dim * np.eye(dim)

    def density(v, k):
        e = v - z[y == k].mean(axis=0)
        return -0.5 * (e @ np.linalg.inv(shrunk[k]) @ e + np.linalg.slogdet(shrunk[k])[1])

    scores = {r.doc_id: r for r in Q.quality_scores(d, m).collect()}
    for i, _ in docs:
        v = (x[i] - a.mean(axis=0)) / scale
        diff = density(v, 1) - density(v, 0)
        assert abs(diff - model.difference(x[i][None])[0]) < 1e-6 * max(1, abs(diff))
        link = model.slope * math.copysign(math.log1p(abs(diff)), diff) + model.offset
        assert abs(scores[i].score - 1 / (1 + math.exp(-link))) < 1e-6
        assert scores[i].held_out == (crc32(str(i).encode()) % 4 == 2) and scores[i].predicted == int(scores[i].score >= 0.7)
    assert model.slope > 0
    right = [scores[i].predicted == q for i, q, _ in labels if scores[i].held_out]
    assert sum(right) >= 0.95 * len(right)
