"""URL rules backed by trust and distrust over the host graph (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import ascii_lower, cut, only, table

#: (host, path prefix, verdict).  A rule holds for its host and all subdomains.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DAMPING = 0.85
ROUNDS = 12
#: Lineage is cut after so many rounds.
CUT_EVERY = 4
#: A host is blocked if its distrust is over so many times its trust.
RATIO = 3.0
#: The SQL, for small tables, also wants so many millionths of the seeds' mass.
FLOOR = 0.01


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The struct (rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # a longer rule overrides
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): the share of a host's links to other hosts that go to ``dst``.

    Links are the absolute and the ``//host`` targets of href attributes.  Counts
    per pair of hosts are pre-aggregated map-side, so that a host with a third of
    all pages shuffles a row per linked host and partition only.
    """
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    each = pages.select(host_of(F.col("url")).alias("src"), F.explode_outer(links).alias("_to")).select("src", ascii_lower(F.col("_to")).alias("dst"))
    counts = each.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    out = counts.groupBy("src").agg(F.sum("n").alias("_all"))
    return counts.join(out, "src").select("src", "dst", (F.col("n") / F.col("_all")).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: (host, score) after ``rounds`` steps from ``seeds`` (host, mass).

    Mass at a host without links out leaves the graph.  Contributions are summed
    by target with map-side aggregation; hosts that no mass reaches have no row.
    """
    jump = seeds.select("host", ((1 - damping) * F.col("mass")).alias("score"))
    rank = seeds.select("host", F.col("mass").alias("score"))
    for i in range(rounds):
        moved = rank.join(edges, rank["host"] == edges["src"]).select(
            F.col("dst").alias("host"), (damping * F.col("score") * F.col("weight")).alias("score")
        )
        rank = moved.unionByName(jump).groupBy("host").agg(F.sum("score").alias("score"))
        if i % CUT_EVERY == CUT_EVERY - 1:
            rank = cut(rank)
    return rank


def shares(hosts: DataFrame, count: str) -> DataFrame:
    """(host, mass): a host's count as a share of all pages that a rule judges.

    Trust and distrust have the same scale so: a page weighs as much in either.
    """
    whole = hosts.agg(F.sum(F.col("allowed") + F.col("barred")).alias("_all"))  # one row
    return hosts.filter(F.col(count) > 0).crossJoin(F.broadcast(whole)).select("host", (F.col(count) / F.col("_all")).alias("mass"))


def host_scores(pages: DataFrame, rules=RULES, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust, blocked) of every host with a page or a link.

    Seeds are the hosts of pages that a rule judges, weighted by their number of
    such pages: allowed pages seed trust, which follows links forward; blocked
    pages seed distrust, which follows links backward, to hosts that link to them.
    """
    judged = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.select("host", longest_rule(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
    hosts = judged.filter("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("verdict") == "block", 1)).alias("barred")
    )
    hosts, edges = cut(hosts), cut(host_edges(pages))
    back = edges.groupBy("dst").agg(F.sum("weight").alias("_all")).join(edges, "dst")
    back = cut(back.select(F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("weight") / F.col("_all")).alias("weight")))
    trust = propagate(shares(hosts, "allowed"), edges, rounds).withColumnRenamed("score", "trust")
    distrust = propagate(shares(hosts, "barred"), back, rounds).withColumnRenamed("score", "distrust")
    both = hosts.select("host").join(trust, "host", "full").join(distrust, "host", "full").na.fill(0.0, ["trust", "distrust"])
    return both.withColumn("blocked", F.col("distrust") > RATIO * F.col("trust"))


def judge_pages(pages: DataFrame, rules=RULES, rounds: int = ROUNDS) -> DataFrame:
    """Host, path, rule and verdict of every page.

    A url's verdict is that of the longest rule that fits.  Where none does, the
    url is blocked if its host is: distrust over ``RATIO`` times trust, from
    personalised PageRank over host links (see ``host_scores``).

    A null url or one without ``://`` has an empty host and path, fits no rule and
    is allowed; an empty path doesn't start with ``/`` and so fits no rule; null
    html has no links; repeated rows are judged alike; an empty table gives no
    rows; extra columns are ignored.
    """
    pages = only(pages, "page_id", "url", "html")
    scores = host_scores(pages, rules, rounds).filter("blocked").select(F.col("host").alias("_bad"))
    out = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    out = out.withColumn("_fit", longest_rule(F.col("host"), F.col("path"), rules))
    out = out.join(scores, (F.col("host") == F.col("_bad")) & F.col("_fit").isNull(), "left")
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("_bad").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("_fit.rule").alias("rule"), verdict.alias("verdict"))


def op10_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"))


def _rule_sql() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    case = lambda out: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{out(h, p, v)}'" for h, p, v in rules) + " END"
    return f"{case(lambda h, p, v: h + p)} AS rule, {case(lambda h, p, v: v)} AS judged"


def _rank_sql(name: str, seeds: str, edges: str) -> str:
    return f"""
{name}(i, host, score) AS (
  SELECT 0, host, mass FROM {seeds}
  UNION ALL
  SELECT i + 1, host, sum(score) FROM (
    SELECT r.i, e.dst AS host, {DAMPING} * r.score * e.weight AS score FROM {name} r JOIN {edges} e ON r.host = e.src
    UNION ALL SELECT k.i, s.host, {1 - DAMPING} * s.mass FROM {seeds} s, (SELECT DISTINCT i FROM {name}) k)
  WHERE i < {ROUNDS} GROUP BY i, host)"""


_HOST = "translate(regexp_extract(coalesce({}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP10_SQL = f"""
WITH RECURSIVE urls AS (
  SELECT *, {_HOST.format("url")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (SELECT *, {_rule_sql()} FROM urls),
links AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM urls),
counts AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
edges AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS weight FROM counts),
back AS (SELECT dst AS src, src AS dst, weight / sum(weight) OVER (PARTITION BY dst) AS weight FROM edges),
hosts AS (SELECT host, count(*) FILTER (WHERE judged = 'allow') AS a, count(*) FILTER (WHERE judged = 'block') AS b FROM ruled WHERE host <> '' GROUP BY host),
trusted AS (SELECT host, a / (SELECT sum(a + b) FROM hosts) AS mass FROM hosts WHERE a > 0),
barred AS (SELECT host, b / (SELECT sum(a + b) FROM hosts) AS mass FROM hosts WHERE b > 0),
{_rank_sql("trust", "trusted", "edges")}, {_rank_sql("distrust", "barred", "back")},
bad AS (
  SELECT d.host FROM distrust d LEFT JOIN trust t ON t.host = d.host AND t.i = {ROUNDS}
  WHERE d.i = {ROUNDS} AND d.score > {RATIO} * coalesce(t.score, 0) AND d.score * 1e6 > {FLOOR})
SELECT page_id, host, path, rule, coalesce(judged, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled
"""
