"""URL verdicts from rules and, where none fits, from the link graph of hosts.

A rule is a host and a path; it fits the host and all below it if the url's path
starts with the rule's path, and of those that fit the longest decides. Pages that
a rule allows or blocks are seeds of their hosts. Trust is a personalised PageRank
from the allowed along host edges; distrust one from the blocked along the edges
reversed (who links to the blocked is suspect). A host's own seeds count once a
page. A host is blocked if its distrust is not 0 and at least ``ratio`` times its
trust, else allowed; a host that neither reaches is allowed.

Edges are counted links between different hosts (relative links stay on theirs),
and, if ``parents``, one each way between a host and the host it lies directly
below, where both have pages. They are summed before anything is joined, a step of
the iteration is a join of edges with scores and a sum, and scores are written to
the shared folder every ``stored_every`` steps. The iteration ends when in these no
host was reached for the first time and no score grew by more than ``tolerance`` of
itself; it raises if that takes ``most_steps``. So a host counts as unreached only if
no path leads to it. The SQL has no such end: it is the same only where ``steps``
rounds are enough, as where there are no edges.

Defined results: a null url or one without ``://`` has host and path ``''`` and is
allowed; a null html has no links; repeated rows count as often as they occur; an
empty table gives an empty result. Other columns pass unchanged unless they have
one of the new names, which then replace them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from featloom.llm.common import quoted, stored

HREF = r"""(?i)<a\s[^>]*href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class GraphSpec:
    damping: float = 0.85
    # Rounds that the SQL spells out; ``judge`` goes on to the tolerance.
    steps: int = 12
    stored_every: int = 4
    ratio: float = 2.0
    parents: bool = True
    # Largest change of any host's score over stored_every rounds, relative to the score.
    tolerance: float = 1e-8
    most_steps: int = 2_000
    # Scores that close to the ratio, relatively, are at it.
    ties: float = 1e-6


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.lit(1 << 30)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest_first(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.text), r.text))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the rule that decides, null if none fits."""

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    return reduce(
        lambda rest, r: F.when(fits(r), r.text).otherwise(rest),
        reversed(_longest_first(rules)),
        F.lit(None).cast("string"),
    )


def host_edges(pages: DataFrame, spec: GraphSpec) -> DataFrame:
    """source, target, weight of ``pages`` (host, html)."""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("link"))
    whole = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    edges = (
        links.select(F.col("host").alias("source"), host_of(whole).alias("target"))
        .where("source != '' AND target != '' AND source != target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("weight"))
    )
    if not spec.parents:
        return edges
    hosts = pages.select("host").where("host != ''").distinct()
    above = hosts.select("host", F.regexp_extract("host", r"^[^.]*\.(.+)$", 1).alias("parent"))
    pairs = above.join(hosts.withColumnRenamed("host", "parent"), "parent")
    one = F.lit(1).cast("long").alias("weight")
    return (
        edges.unionByName(pairs.select(F.col("host").alias("source"), F.col("parent").alias("target"), one))
        .unionByName(pairs.select(F.col("parent").alias("source"), F.col("host").alias("target"), one))
        .groupBy("source", "target")
        .agg(F.sum("weight").alias("weight"))
    )


def host_scores(edges: DataFrame, seeds: DataFrame, spec: GraphSpec) -> DataFrame:
    """host, trust, distrust. ``seeds``: host, kind (trust or distrust), seed."""
    moves = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("from"), F.col("target").alias("to"), "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("from"), F.col("source").alias("to"), "weight")
    )
    out = moves.groupBy("kind", "from").agg(F.sum("weight").alias("whole"))
    moves = stored(
        moves.join(out, ["kind", "from"]).select("kind", "from", "to", (F.col("weight") / F.col("whole")).alias("share")),
        "host-moves",
    )
    seeds = stored(seeds, "host-seeds")
    kept = seeds.select("kind", "host", (F.col("seed") * (1 - spec.damping)).alias("score"))
    scores, rounds, settled = kept, 0, False
    while not settled:
        if rounds >= spec.most_steps:
            raise RuntimeError(f"host scores still change by more than {spec.tolerance} after {rounds} rounds")
        before = scores.select(F.col("kind").alias("of"), F.col("host").alias("at"), F.col("score").alias("was"))
        for _ in range(spec.stored_every):
            moved = moves.join(scores.withColumnRenamed("host", "from"), ["kind", "from"]).select(
                "kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * spec.damping).alias("score")
            )
            scores = kept.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        scores = stored(scores, "host-scores")
        rounds += spec.stored_every
        # Scores only grow; a host reached for the first time has none before.
        grown = F.col("was").isNull() | (F.col("was") < F.col("score") * (1 - spec.tolerance))
        settled = (
            scores.join(before, (F.col("kind") == F.col("of")) & (F.col("host") == F.col("at")), "left")
            .agg(F.coalesce(F.max(grown), F.lit(False)))
            .first()[0]
        ) is False
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return scores.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[Rule], spec: GraphSpec = GraphSpec()) -> DataFrame:
    """``pages`` (url, html) without html, with host, path, rule, verdict, trust, distrust."""
    allowed = [r.text for r in rules if r.allow]
    parted = pages.withColumn("_host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    parted = parted.withColumn("host", F.col("_host")).drop("_host")
    ruled = parted.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    seeds = (
        ruled.where("rule IS NOT NULL AND host != ''")
        .groupBy("host", F.when(F.col("rule").isin(allowed), "trust").otherwise("distrust").alias("kind"))
        .agg(F.count("*").alias("seed"))
    )
    scores = host_scores(host_edges(parted.select("host", "html"), spec), seeds, spec)
    # Relative, as a host far from its seeds has small scores.
    blocked = (F.col("distrust") > 0) & (F.col("distrust") >= F.col("trust") * spec.ratio * (1 - spec.ties))
    scores = scores.withColumnsRenamed({"host": "of"}).withColumn("bad", blocked)
    by_rule = F.when(F.col("rule").isin(allowed), "allow").otherwise("block")
    by_graph = F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")
    kept = [c for c in ruled.columns if c not in ("html", "trust", "distrust", "verdict", "of", "bad")]
    columns = [quoted(c) for c in kept]
    return ruled.select(columns).join(scores, F.col("host") == F.col("of"), "left").select(
        *columns,
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_graph).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def sql(rules: Sequence[Rule], spec: GraphSpec = GraphSpec()) -> str:
    """``judge`` over the table pages in DuckDB's SQL, without the scores."""

    def host(url: str) -> str:
        # Only A-Z: other letters stay as they are.
        got = f"regexp_extract({url}, '^[^/?#]*')"
        return f"translate({got}, '{ascii_uppercase}', '{ascii_lowercase}')"

    rest = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) END"
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in _longest_first(rules)
    )
    allowed = ", ".join(f"'{r.text}'" for r in rules if r.allow)
    href = HREF.replace("'", "''")
    parents = "" if not spec.parents else """
  UNION ALL SELECT host, parent, 1 FROM pairs UNION ALL SELECT parent, host, 1 FROM pairs"""
    steps = "".join(
        f""", s{i + 1} AS (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT kind, host, score FROM s0
    UNION ALL SELECT m.kind, m.goal, s.score * m.share * {spec.damping}
    FROM moves m JOIN s{i} s ON m.kind = s.kind AND m.start = s.host
  ) GROUP BY ALL
)"""
        for i in range(spec.steps)
    )
    return f"""
WITH r AS (SELECT page_id, html, {rest.format("url")} AS rest FROM pages),
p AS (
  SELECT page_id, html, coalesce({host("rest")}, '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM r
), ruled AS (SELECT *, CASE {cases} END AS rule FROM p),
links AS (SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS link FROM p),
whole AS (SELECT host, CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END AS link FROM links),
ends AS (SELECT host, {rest.format("link")} AS rest FROM whole),
found AS (SELECT host AS source, {host("rest")} AS target FROM ends WHERE rest IS NOT NULL),
hosts AS (SELECT DISTINCT host FROM p WHERE host <> ''),
pairs AS (
  SELECT h.host, b.host AS parent FROM hosts h JOIN hosts b
  ON b.host = regexp_extract(h.host, '^[^.]*\\.(.+)$', 1)
), edges AS (
  SELECT source, target, sum(n) AS weight FROM (
  SELECT source, target, 1 AS n FROM found WHERE source <> '' AND target <> '' AND source <> target{parents}
  ) GROUP BY ALL
), both_ways AS (
  SELECT 'trust' AS kind, source AS start, target AS goal, weight FROM edges
  UNION ALL SELECT 'distrust', target, source, weight FROM edges
), moves AS (
  SELECT kind, start, goal, weight::DOUBLE / sum(weight) OVER (PARTITION BY kind, start) AS share FROM both_ways
), s0 AS (
  SELECT CASE WHEN rule IN ({allowed}) THEN 'trust' ELSE 'distrust' END AS kind, host,
         count(*) * (1 - {spec.damping}::DOUBLE) AS score
  FROM ruled WHERE rule IS NOT NULL AND host <> '' GROUP BY ALL
){steps}, scores AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust,
         coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust
  FROM s{spec.steps} GROUP BY host
)
SELECT r.page_id, r.host, r.path, r.rule,
       CASE WHEN rule IN ({allowed}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN distrust > 0 AND round(distrust, 9) >= round(trust * {spec.ratio}, 9) THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN scores s ON r.host = s.host
"""
