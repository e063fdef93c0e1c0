"""Quality by a regularised quadratic discriminant over text statistics (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import UPPER, crc_of_id, cut, only, table, without_ids
from linkwright.llm.text_stats import removed, with_counts

#: Labelled rows to fit on at most: those of least hash of the id.
MAX_TRAIN = 20_000
#: Class covariances move so far to the pooled one, and that so far to the identity.
TO_POOLED, TO_IDENTITY = 0.2, 0.02
THRESHOLD = 0.7

#: name -> SQL over the counts; each is finite for every text, the empty one included.
FEATURES = {
    "words": "ln(1 + n_words)",
    "symbols": "ln(0.005 + n_symbols / greatest(word_chars, 1))",
    "dup_lines": "sqrt(n_dup_lines / greatest(n_lines, 1))",
    "repeats": "sqrt(n_repeat_words / greatest(n_words, 1))",
    "word_length": "ln(1 + word_chars / greatest(n_words, 1))",
    "distinct": "sqrt(n_distinct / greatest(n_words, 1)) * (1 + ln(1 + n_words) / 10)",
    "capitals": "ln(0.01 + n_upper / greatest(word_chars, 1))",
    "stops": "ln(0.01 + n_stops / greatest(n_words, 1))",
    "shouts": "ln(0.005 + n_shouts / greatest(n_words, 1))",
    "digits": "ln(0.01 + n_digits / greatest(word_chars, 1))",
    "line_words": "ln(1 + n_words / greatest(n_lines, 1))",
}


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>): the transformed statistics of every whole text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = with_counts(only(docs, "doc_id", "text"), distinct=True).withColumns(
        {"n_upper": removed(body, UPPER), "n_stops": removed(body, ".,;:"), "n_shouts": removed(body, "!?"), "n_digits": removed(body, "0123456789")}
    )
    return rows.select("doc_id", F.array(*[F.expr(e).cast("double") for e in FEATURES.values()]).alias("x"))


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians with cached Cholesky factors, and the link from their difference to a probability."""

    mean: np.ndarray  # of the standardisation
    scale: np.ndarray
    centres: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]  # inverses of the lower Cholesky factors
    logdets: tuple[float, float]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0."""
        z = (x - self.mean) / self.scale
        dens = []
        for c, f, d in zip(self.centres, self.factors, self.logdets, strict=True):
            dens.append(-0.5 * (((z - c) @ f.T) ** 2).sum(axis=1) - d)
        return dens[1] - dens[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        v = np.clip(self.slope * squashed(self.difference(x)) + self.offset, -35, 35)
        return 1 / (1 + np.exp(-v))


def squashed(d: np.ndarray) -> np.ndarray:
    """Log-density differences on a scale that far outliers don't rule."""
    return np.sign(d) * np.log1p(np.abs(d))


def fit(x: np.ndarray, y: np.ndarray) -> Discriminant | None:
    """The discriminant of labelled rows; None unless both classes have two rows."""
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    parts = [z[y == k] for k in (0, 1)]
    covs = [np.cov(p, rowvar=False, bias=True) for p in parts]
    pooled = sum(c * len(p) for c, p in zip(covs, parts, strict=True)) / len(z)
    centres, factors, logdets = [], [], []
    for c, p in zip(covs, parts, strict=True):
        c = (1 - TO_POOLED) * c + TO_POOLED * pooled
        c = (1 - TO_IDENTITY) * c + TO_IDENTITY * max(np.trace(c) / len(c), 1e-6) * np.eye(len(c))
        low = np.linalg.cholesky(c)
        centres.append(p.mean(axis=0))
        factors.append(np.linalg.inv(low))
        logdets.append(float(np.log(np.diag(low)).sum()))
    plain = Discriminant(mean, scale, tuple(centres), tuple(factors), tuple(logdets), 1.0, 0.0)
    d, w, b = squashed(plain.difference(x)), 1.0, 0.0
    for _ in range(30):  # Newton steps for a logistic link, kept rising by the floor on the slope
        p = 1 / (1 + np.exp(-np.clip(w * d + b, -35, 35)))
        r, h = p - y, p * (1 - p) + 1e-9
        g = np.array([(r * d).sum() + 1e-3 * w, r.sum()])
        m = np.array([[(h * d * d).sum() + 1e-3, (h * d).sum()], [(h * d).sum(), h.sum()]])
        step = np.linalg.solve(m, g)
        w, b = w - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Discriminant(mean, scale, tuple(centres), tuple(factors), tuple(logdets), float(max(w, 1e-3)), float(b))


def fitted(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Discriminant | float:
    """Fit on a bounded sample of labelled rows outside the held-out quarter; the share of class 1 if that can't be done."""
    marks = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL AND crc32(encode(cast(doc_id AS string), 'UTF-8')) % 4 <> 2")
    marks = marks.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    marks = marks.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(max_train).select("doc_id", "quality")
    rows = stats.join(F.broadcast(marks), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id")  # max_train rows at most
    got = rows.select("x", "quality").toArrow()
    y = np.array(got.column("quality").to_pylist(), dtype=np.int64)
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(len(y), len(FEATURES))
    return fit(x, y) or (float(y.mean()) if len(y) else 0.5)


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Counts of the whole text, transformed to statistics on comparable scales, get a
    Gaussian per label with a shrunken covariance; the difference of the two log
    densities, from Mahalanobis distances by cached Cholesky factors, is mapped to
    0..1 by a rising logistic link.  Fitted on at most ``max_train`` labelled rows,
    never on ids whose crc32 is 2 modulo 4.  Only the text enters a score.

    Null and blank texts score as the empty text; null ids are scored and held out
    by the crc32 of the empty text; repeated rows score alike; without labels of
    both classes every score is the share of class 1 (0.5 without labels); an empty
    table gives no rows; extra columns are ignored.
    """
    stats = cut(statistics(docs))
    model = fitted(stats, labels, max_train)

    def scored(batches):
        import pyarrow as pa

        for b in batches:
            x = np.array(b.column("x").to_pylist(), dtype=np.float64).reshape(b.num_rows, len(FEATURES))
            s = model.score(x) if isinstance(model, Discriminant) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    out = stats.mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def only_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted to be of quality, with all their columns."""
    return without_ids(docs, quality_scores(docs, labels).filter("predicted = 0"))


def op7_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
