"""Nulls, blanks, repeated rows, clashing columns and empty tables, for every operator."""

import pytest
from pyspark.sql import functions as F

from linkwright.llm import class_lm, decontaminate, license_scan, near_dups, packing, quality_classifier, quality_rules, sharding, toxicity, url_filter

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "fr", None), (None, "no id here at all", "en", "b"),
    (5, LONG, "en", "a"), (6, "one two three four five six seven", "en", "a"), (6, "one two three four five six seven", "en", "a"), (7, "Straße ÀÉ \x0b x\x0cy", "de", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for clash in ("rid", "node", "n", "word", "_row", "label", "shard", "bucket", "x", "score"):
        docs = docs.withColumn(clash, F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (5, 1, 1), (6, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "two three four five"), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    return docs, labels, items


def calls(docs, labels, items):
    return {
        1: near_dups.near_duplicates(docs), 2: license_scan.scan_licenses(docs), 4: toxicity.toxicity_scores(docs, labels), 5: packing.pack_documents(docs),
        6: class_lm.lm_scores(docs), 7: quality_classifier.quality_scores(docs, labels), 8: quality_rules.rule_verdicts(docs), 9: sharding.assign_shards(docs),
    }


def test_a_row_per_row(tables):
    for n, df in calls(*tables).items():
        got = df.collect()
        assert len(got) == len(ROWS), n
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS), n


def test_empty_tables(tables):
    docs, labels, items = (t.limit(0) for t in tables)
    for n, df in calls(docs, labels, items).items():
        assert df.collect() == [], n
    assert decontaminate.find_items(docs, items).collect() == []
    assert decontaminate.find_items(tables[0], items).collect() == []


def test_defined_results(tables):
    docs, labels, items = tables
    near = {(r.doc_id, r.component_id): r for r in near_dups.near_duplicates(docs).collect()}
    assert near[(6, 1)].kept is False and near[(1, 1)].kept and near[(3, 3)].n_shingles == 0 and near[(2, 2)].kept and near[(None, None)].n_shingles == 1
    leaks = decontaminate.find_items(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in leaks} == {(1, 1), (6, 1)} and all(r.leaked for r in leaks)
    rules = {r.doc_id: r for r in quality_rules.rule_verdicts(docs).collect()}
    assert rules[2].n_words == 0 and rules[2].base_failed and rules[7].n_words == 4
    sizes = {r.doc_id: r for r in sharding.assign_shards(docs).collect()}
    assert sizes[2].size == 1 and sizes[2].text_crc32 == 0
    lm = {r.doc_id: r for r in class_lm.lm_scores(docs).collect()}
    assert lm[3].n_tokens == 1 and lm[5].n_tokens == 30_001
    pads = {r.doc_id: r for r in packing.pack_documents(docs).collect()}
    assert pads[2].n_tokens == 1 and pads[5].pad_to == 30_001


def test_pages(spark):
    rows = [(1, None, None), (2, "no scheme", "<a href=//x.org/>"), (3, "http://", ""), (4, "HTTP://Sub.EXAMPLE.org/es/q?x#y", "<a>"), (4, "HTTP://Sub.EXAMPLE.org/es/q?x#y", "<a>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = [tuple(r) for r in url_filter.judge_pages(pages).orderBy("page_id").collect()]
    assert got[:3] == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow")]
    assert got[3] == got[4] == (4, "sub.example.org", "/es/q", "example.org/es/", "block")
    assert url_filter.judge_pages(pages.limit(0)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    """Nulls, blanks, a text of 100,000 words, repeats and clashing columns pass every stage; an empty table stays empty."""
    import corpus_pipeline

    long = " ".join(f"word{i % 9973}" for i in range(100_000))
    rows = [*ROWS, (8, long, "en", "a"), (9, long, "en", "a"), (10, "   ", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text"))
    for clash in ("_bad", "_BAD_", "_n", "share", "score", "predicted", "is_toxic", "kept", "bucket", "_row", "fp"):
        docs = docs.withColumn(clash, F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (5, 1, 1), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for name, df in (("labels", labels), ("benchmark", spark.createDataFrame([(1, "three four five six seven"), (2, None)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == [], name
        if name != "packing":
            assert got.columns == docs.columns, name
            ids = [r.doc_id for r in got.select("doc_id").collect()]
            assert ids.count(6) in (0, 2) and set(ids) <= {r[0] for r in rows}, name  # rows of one id stay or go together
        if name == "near_dedup":
            assert 8 in ids and 9 not in ids and 1 in ids and 6 not in ids and {2, 3, 4, 10, None} <= set(ids)
        if name == "decontaminate":
            assert set(ids) == {r[0] for r in rows} - {1, 6}
        if name == "packing":
            assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("kind", ["smallint", "decimal(10,0)", "string"])
def test_ids_of_other_types(spark, kind):
    docs = spark.createDataFrame([(i, f"some words {i % 3} and more") for i in range(30)], "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    assert class_lm.lm_scores(docs, n_classes=4).select("doc_id").distinct().count() == 30
    assert near_dups.near_duplicates(docs, 2).filter("kept").count() == 3
