"""Toxicity by a chain of linear classifiers (operator 4)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import Sent, only, table, without_ids
from linkwright.llm.linear import Rows, fit_logistic, sigmoid

#: Labelled rows to fit on at most (those of least hash of the id), and features at most.
MAX_TRAIN = 12_000
MAX_FEATURES = 16_384
#: A feature must be in so many training texts (in half of them, where there are fewer than twice as many).
MIN_TEXTS = 5
FOLDS = 3
L2 = 2.0
THRESHOLD = 0.5
#: The chain: each category is predicted from the words and the categories before it.
#: ``labels`` marks toxicity and quality only, so the categories are toxicity in sound
#: prose, toxicity in junk, and any toxicity, which decides.
CHAIN = {
    "toxic_prose": "toxic = 1 AND coalesce(quality, 1) = 1",
    "toxic_junk": "toxic = 1 AND quality = 0",
    "toxic": "toxic = 1",
}
WORD = re.compile(r"[^\W\d_]+")
#: Word beginnings of these lengths are features too: they carry over to unseen forms.
STEMS = (4, 5)


def of_word(word: str) -> list[str]:
    return [word, *[f"{n}:{word[:n]}" for n in STEMS if len(word) >= n]]


def of_text(text: str | None) -> Counter:
    """Feature counts of a whole text."""
    out: Counter = Counter()
    for w, n in Counter(WORD.findall((text or "").lower())).items():
        for f in of_word(w):
            out[f] += n
    return out


class Indexed:
    """Maps texts to (feature ids, values); remembers the ids of seen words up to a bound."""

    KEEP = 120_000

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary, self.seen = vocabulary, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts: dict[int, int] = {}
        seen, vocabulary = self.seen, self.vocabulary
        for w, n in Counter(WORD.findall((text or "").lower())).items():
            ids = seen.get(w)
            if ids is None:
                if len(seen) >= self.KEEP:
                    seen.clear()
                ids = seen[w] = tuple(vocabulary[f] for f in of_word(w) if f in vocabulary)
            for i in ids:
                counts[i] = counts.get(i, 0) + n
        return np.fromiter(counts, np.int64, len(counts)), np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))


class Chain:
    """Fitted links: per category its weights on features, on earlier logits, and an intercept."""

    def __init__(self, vocabulary: dict[str, int], links: list[tuple[np.ndarray, float]]):
        self.vocabulary, self.links = vocabulary, links
        self.words = np.column_stack([w[: len(vocabulary)] for w, _ in links]) if links else np.zeros((0, 0))

    def score(self, texts: list[str | None], indexed: Indexed) -> np.ndarray:
        """A row of probabilities per text, one per category of the chain."""
        margins = np.zeros((len(texts), len(self.links)))
        for k, t in enumerate(texts):
            ids, vals = indexed(t)
            if len(ids):
                margins[k] = vals @ self.words[ids]
        out = np.zeros_like(margins)
        earlier = np.zeros((len(texts), 0))
        for j, (w, b) in enumerate(self.links):
            out[:, j] = sigmoid(margins[:, j] + earlier @ w[len(self.vocabulary) :] + b)
            earlier = np.column_stack([earlier, logit(out[:, j])])
        return out


def logit(p: np.ndarray) -> np.ndarray:
    """Probabilities on the logit scale, held within +-4 and scaled to about 1."""
    p = np.clip(p, 0.018, 0.982)
    return np.log(p / (1 - p)) / 4


def fit_chain(x: Rows, marks: np.ndarray, folds: np.ndarray, n_folds: int = FOLDS) -> list[tuple[np.ndarray, float]]:
    """A link per column of ``marks``.

    A later link is trained on out-of-fold predictions of the earlier ones, so that
    it meets in training the errors that it meets in use.
    """
    links = []
    for y in marks.T:
        links.append(fit_logistic(x, y, L2))
        held = np.zeros(len(y))
        for k in range(n_folds):
            here = folds == k
            w, b = fit_logistic(x.take(np.flatnonzero(~here)), y[~here], L2)
            held[here] = sigmoid(x.take(np.flatnonzero(here)).dot(w) + b)
        x = x.with_dense(logit(held))
    return links


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Chain:
    """Fit the chain on a bounded sample of labelled documents.

    The features are the words and word beginnings in most training texts, MIN_TEXTS
    at least, whatever their labels, so that their choice tells nothing about a fold
    held out.  ``max_train`` and ``max_features`` bound what the driver fits.
    """
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    marks = marks.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(max_train)
    marks = marks.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).alias("fold"), *[F.expr(f"cast({e} AS int)").alias(c) for c, e in CHAIN.items()])
    texts = only(docs, "doc_id", "text").join(F.broadcast(marks), "doc_id")  # max_train rows at most

    def counted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made: Counter = Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(made), pa.string()), pa.array(list(made.values()), pa.int64())], ["feature", "n"])
        for b in batches:
            for t in b.column("text").to_pylist():
                made.update(of_text(t).keys())
            if len(made) > 400_000:
                yield flush()
                made.clear()
        yield flush()

    top = texts.select("text").mapInArrow(counted, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    least = max(1, min(MIN_TEXTS, texts.count() // 2))
    top = top.filter(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(max_features)
    vocabulary = {r["feature"]: i for i, r in enumerate(top.orderBy(F.desc("n"), "feature").collect())}

    def sparse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        indexed = Indexed(vocabulary)
        for b in batches:
            got = [indexed(t) for t in b.column("text").to_pylist()]
            ids, vals = pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "fold", *CHAIN)], ids, vals], ["doc_id", "fold", *CHAIN, "ids", "vals"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.select("doc_id", "fold", *CHAIN, "text").mapInArrow(
        sparse, f"doc_id {kind}, fold long, {', '.join(f'{c} int' for c in CHAIN)}, ids array<int>, vals array<float>"
    ).toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    y = np.column_stack([got.column(c).to_numpy() for c in CHAIN]).astype(float)[order]
    folds = got.column("fold").to_numpy()[order]
    lens = np.concatenate([np.diff(c.offsets.to_numpy()) for c in got.column("ids").chunks] or [np.empty(0)])
    flat = lambda name, kind: np.concatenate([c.flatten().to_numpy() for c in got.column(name).chunks] or [np.empty(0)]).astype(kind, copy=False)
    x = Rows(flat("ids", np.int32), flat("vals", np.float32), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64), np.zeros((len(y), 0)), len(vocabulary))
    del got
    x = x.take(order)
    return Chain(vocabulary, fit_chain(x, y, folds))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, p_<category> ..., is_toxic) of every document.

    Each category is a logistic model over the log counts of the whole text's words
    and word beginnings and over the probabilities of the categories before it,
    learned from out-of-fold predictions.  A document is toxic if the last
    category's probability reaches ``threshold``.

    Null and blank texts score as texts without words; repeated rows score alike;
    without labels every probability is near one half, and without toxic ones near
    0; an empty table gives no rows; extra columns are ignored.
    """
    chain = train(docs, labels)
    names = [f"p_{c}" for c in CHAIN]
    sent = Sent(docs.sparkSession, chain)  # MAX_FEATURES words and weights

    def scored(batches: Iterator) -> Iterator:
        import pyarrow as pa

        chain = sent.get()
        indexed = Indexed(chain.vocabulary)
        for b in batches:
            p = chain.score(b.column("text").to_pylist(), indexed)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(p[:, j]) for j in range(len(names))]], ["doc_id", *names])

    docs = only(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(scored, f"doc_id {kind}, {', '.join(f'{n} double' for n in names)}")
    return out.withColumn("is_toxic", F.col(names[-1]) >= threshold)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't toxic, with all their columns."""
    return without_ids(docs, toxicity_scores(docs, labels).filter("is_toxic"))


def op4_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
