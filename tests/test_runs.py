"""Command lines, the boosted model, text reports and sinks on a small set of record files."""

import pytest
from pyspark.sql import functions as F

from linkwright.functions.text import romanise
from linkwright.operators import decision, features, matcher, metrics, sampling
from linkwright.operators.normalize import normalize
from linkwright.operators.validate import validate
from linkwright.plans import linkage, run
from linkwright.sources import records, results

WORDS = "amber basalt cedar dune ember fjord garnet harbor indigo jasper kelp lagoon".split()


def shop(i):
    return f"{WORDS[i % 12]} {WORDS[(i * 5 + 3) % 12]} {WORDS[i // 12 % 12]} works", f"{100 + i} {WORDS[(i * 7) % 12]} street"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """60 shops in each split; every fourth has no second record."""
    at = tmp_path_factory.mktemp("data")
    for split in records.SPLITS:
        rows = {1: [], 2: [], 3: []}
        truth = []
        for i in range(60):
            name, street = shop(i)
            land = ("Peru", "Chile")[i % 2]
            rows[1].append((f"S1-{i:03}", name, street, land))
            if i % 4:
                rows[2 + i % 2].append((f"S{2 + i % 2}-{i:03}", f"{name.title()} Inc.", street.upper(), land))
            truth.append((f"S1-{i:03}", f"S{2 + i % 2}-{i:03}" if i % 4 else ""))
        for k, r in rows.items():
            lines = ["\t".join(records.COLUMNS), *["\t".join(x) for x in r]]
            (at / f"{split}_source{k}.tsv").write_text("\n".join(lines) + "\n")
        (at / f"{split}_ground_truth.tsv").write_text("\n".join(["\t".join(results.MATCHES), *["\t".join(x) for x in truth]]) + "\n")
    return str(at)


def test_baseline_run(spark, data, tmp_path):
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    assert run.baseline(spark, data, work, ("pairs",), out) is None
    assert run.baseline(spark, data, work, ("score", "write"), out) in decision.VARIANTS
    got = spark.read.parquet(f"{work}/baseline_scores")
    assert got.count() == 60 and got.agg(F.avg("f05")).first()[0] == 1.0
    required, known = records.read_ids(spark, records.source_path(data, "test", 1)), records.match_targets(spark, data, "test")
    assert validate(spark, f"{out}/matches", f"{out}/candidates", required, known) == ([], [])
    text = run.report(spark, data, f"{out}/matches")
    assert text.startswith("macro F0.5 1.0000 on 60 S1") and "  0 (singleton): n 15" in text and "  Chile: n 30" in text
    (tmp_path / "ids.tsv").write_text("s1_id\nS1-000\nS1-001\n")
    assert "on 2 S1" in run.report(spark, data, f"{out}/matches", str(tmp_path / "ids.tsv"))


def test_candidates_from_the_command_line(spark, data, tmp_path, capsys):
    args = ["--data", data, "--work", str(tmp_path / "w"), "candidates", "--split", "train", "--max-candidates", "2", "--output", str(tmp_path / "c")]
    assert run.main(args) == 0
    path = capsys.readouterr().out.strip().splitlines()[-1]
    assert spark.read.parquet(path).groupBy("s1_id").count().agg(F.max("count")).first()[0] <= 2
    rows, fatal = results.parse_results(spark, str(tmp_path / "c"), results.CANDIDATES)
    assert not fatal and rows.count() == 60


@pytest.fixture(scope="module")
def pairs(spark, data):
    raw = records.read_source(spark, data, "train", 1).unionByName(records.read_source(spark, data, "train", 2)).unionByName(records.read_source(spark, data, "train", 3))
    norm = normalize(raw).checkpoint()
    s1, targets = linkage.split_sources(norm)
    truth = records.truth_pairs(records.read_truth(spark, f"{data}/train_ground_truth.tsv")).withColumnRenamed("match_id", "cand_id")
    every = s1.select(F.col("entity_id").alias("s1_id"), "country").join(targets.select(F.col("entity_id").alias("cand_id"), "country"), "country").drop("country")
    folded = sampling.folds(linkage.s1_ids(s1), 2)
    rows, n_true = matcher.labelled(features.pair_features(every, norm), truth, folded)
    return rows.checkpoint(), n_true, truth, linkage.s1_ids(s1)


def test_labelled(pairs):
    rows, n_true, truth, s1 = pairs
    assert rows.agg(F.sum("y")).first()[0] == truth.count() == 45
    assert {r["n_true"]: r["count"] for r in n_true.groupBy("n_true").count().collect()} == {0: 15, 1: 45}


def test_boosted_is_kept(spark, pairs, tmp_path):
    rows, _, truth, s1 = pairs
    made = matcher.Boosted(rounds=3, k=2)
    oof = made.fit(rows, ["name_ratio", "addr_ratio"], s1, truth)
    assert oof.columns == ["s1_id", "cand_id", "p", "y"] and oof.count() == rows.count()
    assert made.macro_f05 > 0.9 and 1 <= made.trees <= 3 and made.decision["method"] in ("threshold", "expected_f")
    kept = metrics.macro(metrics.entity_scores(decision.decide(made.score(rows).select("s1_id", "cand_id", "p"), made.decision), truth, s1)).first()
    assert kept["macro_f05"] > 0.9
    gains = list(made.importances().values())
    assert gains == sorted(gains, reverse=True) and abs(sum(gains) - 1) < 1e-6
    made.save(str(tmp_path / "m"))
    again = matcher.Boosted.load(str(tmp_path / "m"))
    assert again.decision == made.decision and again.trees == made.trees
    p = lambda m: {(r.s1_id, r.cand_id): r.p for r in m.score(rows).collect()}
    assert p(again) == p(made)


def test_feature_groups(pairs):
    rows = pairs[0]
    got = {r["features"]: r for r in matcher.feature_groups(rows, ["name_ratio", "addr_ratio"], "y", k=2, rounds=2).collect()}
    assert set(got) == {"name", "all"} and all(0.9 < r["auc"] <= 1 for r in got.values()) and all(0 < r["recall"] <= 1 for r in got.values())


def test_grid_equals_decisions(pairs):
    """Every setting of the grid against its decision on its own."""
    rows, _, truth, s1 = pairs
    scored = rows.select("s1_id", "cand_id", F.col("name_ratio").alias("p"), "y")
    grid = {(r["method"], r["a"], r["b"]): r["macro_f05"] for r in matcher.decision_grid(scored, s1, truth).collect()}
    assert len(grid) == 21
    for how, key in (({"method": "threshold", "t": 0.7}, ("threshold", 0.7, 0.0)), ({"method": "expected_f", "c": 0.5, "r": 1.5}, ("expected_f", 0.5, 1.5))):
        got = metrics.macro(metrics.entity_scores(decision.decide(scored, how), truth, s1)).first()["macro_f05"]
        assert got == pytest.approx(grid[key])


def test_auc_leaves_out_missing_values(spark):
    rows = [(1, 0.9, 0.1), (1, 0.4, None), (0, 0.4, 0.2), (0, 0.1, 0.3)]
    got = {r["feature"]: r for r in metrics.feature_auc(spark.createDataFrame(rows, "y int, a double, b double"), ["a", "b"]).collect()}
    assert got["a"]["auc"] == pytest.approx(3.5 / 4) and got["a"]["coverage"] == 1
    assert got["b"]["auc"] == 0 and got["b"]["coverage"] == 0.75 and got["b"]["strength"] == 1


def test_small_sinks(spark, tmp_path):
    results.write_marker(spark, str(tmp_path / "m"), "addr_only")
    assert results.read_marker(spark, str(tmp_path / "m")) == "addr_only"
    results.write_json({"pairs": 3}, str(tmp_path / "r.json"))
    assert results.read_json(str(tmp_path / "r.json")) == {"pairs": 3}
    rows = [("a, b", 'say "so"'), ("c", "two\nlines")]
    results.write_csv(spark.createDataFrame(rows, "x string, y string"), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in results.read_csv(spark, str(tmp_path / "c")).collect()) == sorted(rows)


def test_romanised_scripts(spark):
    # Cyrillic, Greek, Hangul, Hebrew, Arabic, Gujarati
    cases = {"Москва": "moskva", "Жук": "zhuk", "Ελλάς": "ellas", "서울 한국": "seoul hanguk", "שלום": "shlvm", "بنك": "bnk", "plain é": "plain é", "": ""}
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", romanise(F.col("t")).alias("r")).collect()
    assert {r.t: r.r.lower() for r in got} == cases
