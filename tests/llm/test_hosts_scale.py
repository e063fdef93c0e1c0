"""Verdicts of a host graph in a table with many pages elsewhere."""

from pyspark.sql import functions as F

from linkwright.llm import url_filter


def test_the_verdict_does_not_depend_on_the_number_of_other_pages(spark):
    rows = [(0, "http://bad.com/de/", ""), (1, "http://near.net/", "".join(f'<a href="http://{h}/">' for h in ["bad.com"] + ["c.net"] * 99))]
    # near.net is one of a hundred hosts that link to bad.com
    rows += [(i, f"http://n{i}.net/", '<a href="http://bad.com/">') for i in range(2, 102)]
    few = spark.createDataFrame(rows, "page_id long, url string, html string")
    others = spark.range(1_000, 501_000).select(F.col("id").alias("page_id"), F.lit("http://good.org/").alias("url"), F.lit("").alias("html"))
    got = [{r.host for r in url_filter.host_scores(t).filter("blocked").collect()} for t in (few, few.unionByName(others))]
    assert got[0] == got[1] and "near.net" in got[0]
