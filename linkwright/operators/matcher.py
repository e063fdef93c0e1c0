"""Learned matchers over pair features, on pyspark.ml."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.operators.decision import one_owner
from linkwright.operators.metrics import average_precision, best_threshold, f_beta, feature_auc
from linkwright.plans.staging import settled

MISSING = -1.0
# The decisions that are compared.
THRESHOLDS = (0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.8, 0.9)
EXPECTED_F = tuple((c, r) for c in (0.0, 0.5, 1.0) for r in (1.0, 1.5, 2.0, 3.0))


def filled(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """Features with -1 for missing values and an indicator of each: trees and linear models here take no nulls."""
    marks = {f"{c}_missing": F.col(c).isNull().cast("double") for c in features}
    df = df.withColumns(marks).na.fill(MISSING, features)
    return df, [*features, *marks]


def balanced(df: DataFrame, label: str) -> DataFrame:
    """A weight that gives both classes half of the whole."""
    sums = df.agg(F.count("*").alias("_n"), F.sum(F.col(label).cast("double")).alias("_p"))
    return df.crossJoin(F.broadcast(sums)).withColumn(
        "_w", F.when(F.col(label) == 1, F.try_divide("_n", 2 * F.col("_p"))).otherwise(F.try_divide("_n", 2 * (F.col("_n") - F.col("_p"))))
    ).drop("_n", "_p")


class Matcher:
    """Logistic regression with balanced classes and a threshold."""

    def __init__(self, threshold: float = 0.65):
        self.threshold, self.features, self.model = threshold, [], None

    def fit(self, df: DataFrame, features: list[str], label: str = "y") -> Matcher:
        self.features = list(features)
        df, columns = filled(df, self.features)
        stages = [
            VectorAssembler(inputCols=columns, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_x", withMean=True),
            LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_w", probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_margin", maxIter=100, regParam=1e-4),
        ]
        self.model = Pipeline(stages=stages).fit(balanced(df, label))
        return self

    def score(self, df: DataFrame) -> DataFrame:
        """The rows with a probability p."""
        names = df.columns
        out = self.model.transform(filled(df, self.features)[0])
        return out.withColumn("p", vector_to_array("_prob")[1]).select(*[c for c in names if c not in self.features], *self.features, "p")

    def predict(self, df: DataFrame) -> DataFrame:
        return self.score(df).withColumn("predicted", (F.col("p") >= self.threshold).cast("int"))

    def tune(self, df: DataFrame, label: str = "y", beta: float = 0.5) -> float:
        """Set the threshold of highest F on labelled rows, from a grid of 0.3 to 0.9."""
        self.threshold = best_threshold(self.score(df).withColumn("y", F.col(label)), beta=beta)
        return self.threshold

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = _session()
        note = json.dumps({"threshold": self.threshold, "features": self.features})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, path: str) -> Matcher:
        note = json.loads(_session().read.text(f"{path}/settings").first()["value"])
        out = cls(note["threshold"])
        out.features, out.model = note["features"], PipelineModel.load(f"{path}/model")
        return out


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def boosted(df: DataFrame, features: list[str], label: str, rounds: int, held: str | None = None):
    """Gradient-boosted trees; ``held`` is a boolean column of rows for early stopping."""
    df, columns = filled(df, features)
    tree = GBTClassifier(featuresCol="_x", labelCol=label, maxIter=rounds, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=42)
    if held is not None:
        tree = tree.setValidationIndicatorCol(held)
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_x"), tree]).fit(df), columns


def out_of_fold(df: DataFrame, features: list[str], label: str = "y", fold: str = "fold", k: int = 5, rounds: int = 20, early: bool = True, trees: list[int] | None = None) -> DataFrame:
    """The rows with p from a model that didn't train on their fold (modulo k).

    With ``early``, a model stops by its error on the fold that it scores, as the
    usual practice has it; such scores are a little optimistic.  ``trees`` takes each
    model's number of trees.
    """
    out = None
    df = df.withColumn("_f", F.pmod(F.col(fold), F.lit(k))).withColumn(label, F.col(label).cast("double"))
    for i in range(k):
        held = df.withColumn("_held", F.col("_f") == i)
        model, _ = boosted(held if early else held.filter("NOT _held"), features, label, rounds, "_held" if early else None)
        if trees is not None:
            trees.append(model.stages[-1].getNumTrees)
        part = model.transform(filled(held.filter("_held"), features)[0]).withColumn("p", vector_to_array("probability")[1])
        part = part.select(*[c for c in df.columns if c not in ("_f", *features)], "p")
        out = part if out is None else out.unionByName(part)
    return out


def labelled(pairs: DataFrame, truth: DataFrame, folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of the S1s of ``folded`` (s1_id, fold) with y and fold, and (s1_id, n_true) of all these S1s."""
    true = truth.select("s1_id", "cand_id").distinct()
    rows = pairs.join(folded.select("s1_id", "fold"), "s1_id").join(true.withColumn("_y", F.lit(1)), ["s1_id", "cand_id"], "left")
    counts = true.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    return rows.withColumn("y", F.coalesce("_y", F.lit(0))).drop("_y"), folded.select("s1_id").join(counts, "s1_id", "left").na.fill(0, ["n_true"])


def best_decision(grid: DataFrame) -> tuple[dict, float]:
    """The setting of highest macro F0.5 in a decision grid, as ``decide`` takes it, and its score; ties go to the first by name and values."""
    r = grid.orderBy(F.desc("macro_f05"), F.desc("method"), "a", "b").first()
    names = ("t",) if r["method"] == "threshold" else ("c", "r")
    return {"method": r["method"], **dict(zip(names, (r["a"], r["b"]), strict=False))}, r["macro_f05"]


class Boosted:
    """Boosted trees with the decision chosen on out-of-fold scores.

    ``fit`` scores every fold with a model of the others, takes the decision of
    highest macro F0.5, and fits a last model on all rows, with as many trees as the
    folds' models had on average.
    """

    def __init__(self, rounds: int = 20, k: int = 5):
        self.rounds, self.k = rounds, k
        self.features, self.model, self.columns, self.decision, self.macro_f05, self.trees = [], None, [], {}, 0.0, 0

    def fit(self, df: DataFrame, features: list[str], s1: DataFrame, truth: DataFrame, label: str = "y", fold: str = "fold") -> DataFrame:
        """The out-of-fold scores (s1_id, cand_id, p, y); the model is kept."""
        made: list[int] = []
        oof = out_of_fold(df, features, label, fold, self.k, self.rounds, trees=made)
        oof = settled(oof.select("s1_id", "cand_id", "p", F.col(label).cast("int").alias("y")))
        self.decision, self.macro_f05 = best_decision(decision_grid(oof, s1, truth))
        self.features, self.trees = list(features), max(1, sum(made) // len(made))
        self.model, self.columns = boosted(df.withColumn(label, F.col(label).cast("double")), features, label, self.trees)
        return oof

    def score(self, df: DataFrame) -> DataFrame:
        """The rows with a probability p."""
        out = self.model.transform(filled(df, self.features)[0]).withColumn("p", vector_to_array("probability")[1])
        return out.select(*[c for c in df.columns if c not in self.features], *self.features, "p")

    def importances(self) -> dict[str, float]:
        return importances(self.model, self.columns)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        note = json.dumps({"features": self.features, "columns": self.columns, "decision": self.decision, "dev_macro_f05": self.macro_f05, "n_trees": self.trees})
        _session().createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, path: str) -> Boosted:
        note, out = json.loads(_session().read.text(f"{path}/settings").first()["value"]), cls()
        out.features, out.columns, out.decision, out.macro_f05, out.trees = (note[k] for k in ("features", "columns", "decision", "dev_macro_f05", "n_trees"))
        out.model = PipelineModel.load(f"{path}/model")
        return out


NAME_FEATURES = ("name_", "legal", "cand_is", "script", "cand_non")


def feature_groups(df: DataFrame, features: list[str], label: str = "label", k: int = 3, rounds: int = 20) -> DataFrame:
    """(features, auc, average_precision, precision, recall) out of fold, by name features alone and by all; rows have folds."""
    from functools import reduce

    out = []
    for name, cols in (("name", [c for c in features if c.startswith(NAME_FEATURES)]), ("all", list(features))):
        oof = settled(out_of_fold(df, cols, label, k=k, rounds=rounds, early=False).select("p", F.col(label).alias("y")))
        rates = oof.agg(F.avg(F.when(F.col("p") > 0.5, F.col("y"))).alias("precision"), F.avg(F.when(F.col("y") == 1, (F.col("p") > 0.5).cast("double"))).alias("recall"))
        one = feature_auc(oof, ["p"]).select("auc").crossJoin(average_precision(oof)).crossJoin(rates)  # a row each
        out.append(one.select(F.lit(name).alias("features"), "auc", "average_precision", "precision", "recall"))
    return reduce(DataFrame.unionByName, out)


def importances(model, columns: list[str]) -> dict[str, float]:
    return dict(sorted(zip(columns, map(float, model.stages[-1].featureImportances.toArray()), strict=True), key=lambda kv: -kv[1]))


def decision_grid(scored: DataFrame, s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(method, a, b, macro_f05) of all decisions on scored pairs (s1_id, cand_id, p, y), in one plan.

    Every setting is a pair of sums per S1, so that pairs are dealt by S1 once and
    never copied; S1s without a chosen pair enter by their counts.
    """
    from pyspark.sql import Window

    own = one_owner(scored).select("s1_id", "cand_id", "p", "y")
    group = Window.partitionBy("s1_id")
    order = group.orderBy(F.desc("p"), "cand_id")
    own = own.withColumns({"_k": F.row_number().over(order), "_sum": F.sum("p").over(order.rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("p").over(group)})
    own = own.withColumn("_no", F.exp(F.sum(F.log1p(-F.least("p", F.lit(1 - 1e-6)))).over(group)))
    places = {c: f"_best{i}" for i, c in enumerate(sorted({c for c, _ in EXPECTED_F}))}
    worth = lambda c: F.struct((1.25 * F.col("_sum") / (0.25 * (F.col("_all") + c) + F.col("_k"))).alias("e"), (-F.col("_k")).alias("k"))
    own = own.withColumns({at: F.max(worth(c)).over(group) for c, at in places.items()})
    settings = [("threshold", t, 0.0, F.col("p") >= t) for t in THRESHOLDS]
    settings += [("expected_f", c, r, (F.col("_k") <= -F.col(f"{places[c]}.k")) & (F.col(f"{places[c]}.e") > r * F.col("_no"))) for c, r in EXPECTED_F]
    sums = [f(chosen).alias(f"{n}{i}") for i, (*_, chosen) in enumerate(settings) for n, f in (("n", F.count_if), ("tp", lambda c: F.sum(F.when(c, F.col("y")).otherwise(0))))]
    counts = own.groupBy("s1_id").agg(*sums)
    n_true = truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    full = s1.select("s1_id").distinct().join(n_true, "s1_id", "left").join(counts, "s1_id", "left").na.fill(0)
    means = [F.struct(F.lit(m).alias("method"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.avg(f_beta(F.col("n_true"), F.col(f"n{i}"), F.col(f"tp{i}"))).alias("macro_f05")) for i, (m, a, b, _) in enumerate(settings)]
    return full.agg(F.array(*means).alias("_m")).select(F.explode("_m").alias("_m")).select("_m.*")
