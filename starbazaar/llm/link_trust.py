"""URL rules, and for the other pages a verdict of their host by propagation over the link graph; DataFrame functions only.

Pages that a rule allows or blocks are seeds, by their host. Trust and the mass of pages without a rule flow along links (personalised
PageRank), distrust flows against them: who links to blocked hosts is distrusted. Host edges are the absolute links of the pages'
``href`` attributes, and one each way between a host and its parent domain where both have pages. A host is blocked if its distrust is
above its trust and at least ``SHARE`` of all that has reached it. Masses flow until less than ``TOLERANCE`` of them all can still move: after
k rounds that is the damping to the power of k, so the number of rounds does not depend on the graph; they end early when nothing moves.

Rules meet hosts, not pages: each host's suffixes are joined with the rules' hosts, so both may be many.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; of rules of equal length the first by
code point wins; pages without html have no links; repeated rows count as often as they stand; a host nothing has reached is allowed;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import table, written

#: Fixed rules: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING, TOLERANCE, SHARE = 0.85, 1e-3, 0.5
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Rounds of one job.
STEP = 8
#: Changes that sums of doubles make by themselves.
_STILL = 1e-13
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?(?:https?:)?//([^/?#"'<> \t\r\n]+)"""
_MASSES = ("trust", "distrust", "neutral")


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (page_id, host, path) with the rule that fits and its verdict, null where none does."""
    spark = pages.sparkSession
    own = spark.createDataFrame(rules, "verdict string, of string, begins string").withColumn(
        "rule", F.concat("of", "begins"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = pages.where("host <> ''").select("host").distinct().select("host", F.explode(suffixes).alias("of"))
    fitting = written(hosts.join(own, "of").groupBy("host").agg(
        F.collect_list(F.struct((-F.length("rule")).alias("order"), "rule", "begins", "verdict")).alias("rules")), "host-rules")
    fits = F.filter("rules", lambda r: F.col("path").startswith(r.begins))
    best = F.get(F.array_sort(fits), F.lit(0))
    return pages.join(fitting, "host", "left").select(
        "page_id", "host", "path", best.rule.alias("rule"), best.verdict.alias("ruled"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """a, b and the weight of the edge, which sums to one over a (``out``) and over b (``back``)."""
    found = pages.select("host", F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER)))).alias("b"))
    links = found.select(F.col("host").alias("a"), "b").where("a <> b AND a <> ''").groupBy("a", "b").agg(F.count("*").alias("n"))
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    up = hosts.select(F.col("host").alias("a"), parent.alias("b")).where("b <> ''").join(
        hosts.select(F.col("host").alias("b")), "b", "left_semi").select("a", "b", F.lit(1).cast("bigint").alias("n"))
    both = up.unionByName(up.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    edges = written(links.unionByName(both).groupBy("a", "b").agg(F.sum("n").alias("n")), "host-edges")
    out = edges.groupBy("a").agg(F.sum("n").alias("out"))
    back = edges.groupBy("b").agg(F.sum("n").alias("back"))
    return written(edges.join(out, "a").join(back, "b").select(
        "a", "b", (F.col("n") / F.col("out")).alias("out"), (F.col("n") / F.col("back")).alias("back")), "edge-weights")


def propagated(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``seeds`` (host and its masses) after ``rounds`` of propagation, or before if nothing moves; every ``STEP`` rounds are written."""
    ends = edges.select(F.col("a").alias("host")).unionByName(edges.select(F.col("b").alias("host")))
    seeds = written(seeds.unionByName(ends.select("host", *(F.lit(0.0).alias(m) for m in _MASSES))).groupBy("host").agg(
        *(F.sum(m).alias(m) for m in _MASSES)), "seeds")
    if edges.isEmpty():
        return seeds
    none = F.lit(0.0)
    # Trust and neutral mass go from a to b, distrust from b to a: one join moves all three.
    flows = written(edges.select(F.col("a").alias("of"), F.col("b").alias("to"), F.col("out").alias("forth"), none.alias("back")).unionByName(
        edges.select(F.col("b").alias("of"), F.col("a").alias("to"), none.alias("forth"), "back")), "flows")
    given = seeds.select("host", *(((1 - damping) * F.col(m)).alias(m) for m in _MASSES))
    now = seeds
    for done in range(0, rounds, STEP):
        after = now
        for _ in range(min(STEP, rounds - done)):
            came = flows.join(after, F.col("of") == F.col("host")).select(F.col("to").alias("host"), *(
                (damping * F.col(m) * F.col("back" if m == "distrust" else "forth")).alias(m) for m in _MASSES))
            after = came.unionByName(given).groupBy("host").agg(*(F.sum(m).alias(m) for m in _MASSES))
        after = written(after, "masses")
        change = after.unionByName(now.select("host", *((-F.col(m)).alias(m) for m in _MASSES))).groupBy("host").agg(
            *(F.sum(m).alias(m) for m in _MASSES))
        moved = change.agg(F.sum(sum((F.abs(F.col(m)) for m in _MASSES), none)).alias("moved")).first()["moved"]
        now = after
        if moved < _STILL:
            break
    return now


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, share: float = SHARE) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html)."""
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    ruled = written(with_rules(parsed, RULES if rules is None else rules), "ruled")
    total = ruled.count() or 1
    counted = ruled.groupBy("host").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("trust"), F.count(F.when(F.col("ruled") == "block", 1)).alias("distrust"),
        F.count(F.when(F.col("ruled").isNull(), 1)).alias("neutral"))
    seeds = written(counted.select("host", *((F.col(m) / total).alias(m) for m in _MASSES)), "host-counts")
    edges = host_edges(pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")), seeds.where("host <> ''").select("host"))
    masses = propagated(seeds, edges)
    part = F.round(F.col("distrust") - share * (F.col("trust") + F.col("distrust") + F.col("neutral")), 12)
    bad = (F.round(F.col("distrust") - F.col("trust"), 12) > 0) & (part >= 0)
    verdicts = written(masses.select("host", F.when(bad, "block").otherwise("allow").alias("method")), "host-verdicts")
    return ruled.join(verdicts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "method", F.lit("allow")).alias("verdict"))


def op4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}', '{h}{p}')" for v, h, p in RULES)
    rounds = "".join(f""", r{i + 1} AS MATERIALIZED (
    SELECT host, sum(trust) AS trust, sum(distrust) AS distrust, sum(neutral) AS neutral FROM (
        SELECT b AS host, {DAMPING} * trust * outw AS trust, 0 AS distrust, {DAMPING} * neutral * outw AS neutral FROM weights JOIN r{i} ON a = host
        UNION ALL SELECT a, 0, {DAMPING} * distrust * backw, 0 FROM weights JOIN r{i} ON b = host
        UNION ALL SELECT host, (1 - {DAMPING}) * trust, (1 - {DAMPING}) * distrust, (1 - {DAMPING}) * neutral FROM r0) GROUP BY host)""" for i in range(ROUNDS))
    href = _HREF.replace("'", "''")
    return f"""
WITH rules(verdict, h, p, rule) AS (VALUES {values}), cut AS (
    SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
    SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
    SELECT *, (SELECT max_by(struct_pack(rule := rule, verdict := verdict), length(rule)) FROM rules
               WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parsed
), seeds AS (
    SELECT host, count(*) FILTER (best.verdict = 'allow') / (SELECT count(*) FROM pages) AS trust,
           count(*) FILTER (best.verdict = 'block') / (SELECT count(*) FROM pages) AS distrust,
           count(*) FILTER (best IS NULL) / (SELECT count(*) FROM pages) AS neutral FROM ruled GROUP BY host
), found AS (
    SELECT host AS a, translate(unnest(list_distinct(list_transform(regexp_extract_all(html, '{href}', 1), lambda x: translate(x, '{_UPPER}', '{_LOWER}')))), '', '') AS b
    FROM parsed
), up AS (
    SELECT host AS a, regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1) AS b FROM seeds
), edges AS (
    SELECT a, b, sum(n) AS n FROM (
        SELECT a, b, 1 AS n FROM found WHERE a <> b AND a <> ''
        UNION ALL SELECT a, b, 1 FROM up WHERE b IN (SELECT host FROM seeds) AND b <> ''
        UNION ALL SELECT b, a, 1 FROM up WHERE b IN (SELECT host FROM seeds) AND b <> '') GROUP BY a, b
), weights AS MATERIALIZED (
    SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS outw, n / sum(n) OVER (PARTITION BY b) AS backw FROM edges
), r0 AS MATERIALIZED (
    SELECT host, sum(trust) AS trust, sum(distrust) AS distrust, sum(neutral) AS neutral FROM (
        SELECT * FROM seeds UNION ALL SELECT a, 0, 0, 0 FROM weights UNION ALL SELECT b, 0, 0, 0 FROM weights) GROUP BY host
){rounds}
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN round(distrust - trust, 12) > 0
       AND round(distrust - {SHARE} * (trust + distrust + neutral), 12) >= 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN r{ROUNDS} USING (host)
"""


ORACLE_SQL = _oracle()
