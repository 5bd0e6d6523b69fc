"""URL filter: explicit rules, then a tree of path templates per host.

Rules ``host/path`` fit their host and all its subdomains if the url's path starts with the
rule's; the longest rule wins. Urls without a rule get the verdict of their path template.

Templates: the runs of digits in a path's segments become ``{n}`` (so numbered pages
share a segment). At every node, child segments that cannot be told from variable values become
one wildcard: those with so few urls in their subtree as a value that does not repeat (a count of
mean 1, at most ``Z`` standard errors above) whose share of blocked labels does not differ from their
siblings' by more than ``Z`` standard errors. Other segments stay, whatever the number of
siblings, down to the end of every path. A node's labels are the verdicts of
the rules that fit urls below it. From the root down, every node's share of blocked labels is
smoothed by its parent's with the weight of ``PRIOR`` labels: the root's by 1/2, a
host's by the root's, a template's by its parent's. Sibling branches whose share does
not differ from their siblings' by more than ``Z`` standard errors are merged: they take the
siblings' common counts. A template of a smoothed share above ``REJECT`` is blocked.

The tree is built from one row per distinct (host, template) with counts, so a host that
holds most urls is folded before the shuffle; only the last join meets every url, and its hot keys
can be split. Defined cases: a null url, or one without ``://``, has empty host and path, no
rule, and the verdict of that empty template; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

#: (verdict, rule) of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
PRIOR = 4.0
Z = 1.96
#: The wildcard's place in a node (no segment is empty).
ANY = ""
REJECT = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, below = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + below))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _smoothed(nodes: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """``nodes`` (labels, blocked) with ``share`` smoothed by the parent's ``share``; similar siblings merged."""
    pooled = stored(nodes.groupBy(*on).agg(F.sum("labels").alias("all_labels"), F.sum("blocked").alias("all_blocked")), "url-pooled")
    up = stored(pooled.join(parents.select(*on, F.col("share").alias("up")), on), "url-parents")
    joined = nodes.join(up, on)
    common = (F.col("all_blocked") + PRIOR * F.col("up")) / (F.col("all_labels") + PRIOR)
    own = (F.col("blocked") + PRIOR * F.col("up")) / (F.col("labels") + PRIOR)
    error = F.sqrt(common * (1 - common) / F.greatest(F.col("labels"), F.lit(1)))
    similar = (F.col("labels") > 0) & (F.abs(own - common) <= Z * error)
    share = F.when(F.col("labels") == 0, F.col("up")).when(similar, common).otherwise(own)
    return stored(joined.withColumn("share", share).select(*nodes.columns, "share"), "url-shares")


def _constant(children: DataFrame) -> DataFrame:
    """``(host, node, child)`` with ``constant``: whether the child can be told from a variable value."""
    siblings = children.groupBy("host", "node").agg(F.sum("labels").alias("all_labels"), F.sum("blocked").alias("all_blocked"))
    rest, common = F.col("all_labels") - F.col("labels"), F.try_divide("all_blocked", "all_labels")
    error = F.sqrt(common * (1 - common) * (F.try_divide(F.lit(1), "labels") + F.try_divide(F.lit(1), rest)))
    apart = F.abs(F.try_divide("blocked", "labels") - F.try_divide(F.col("all_blocked") - F.col("blocked"), rest)) > Z * error
    constant = (F.col("urls") > 1 + Z) | F.coalesce(apart, F.lit(False))
    return children.join(stored(siblings, "url-all"), ["host", "node"]).select("host", "node", "child", constant.alias("constant"))


def template_shares(rows: DataFrame) -> DataFrame:
    """``(host, segments, share)`` per distinct template of rows ``(host, segments, verdict)``."""
    counts = [F.count(F.lit(1)).alias("urls"), F.count("verdict").alias("labels"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")]
    shapes = stored(rows.groupBy("host", "segments").agg(*counts), "url-shapes").withColumn("node", F.array().cast("array<string>"))
    whole = shapes.agg(F.sum("blocked").alias("blocked"), F.sum("labels").alias("labels")).first()
    top = ((whole["blocked"] or 0) + PRIOR / 2) / ((whole["labels"] or 0) + PRIOR)
    sums = [F.sum(c).alias(c) for c in ("urls", "labels", "blocked")]
    hosts = shapes.groupBy("host").agg(*sums)
    own = (F.col("blocked") + PRIOR * top) / (F.col("labels") + PRIOR)
    shares = stored(hosts.select("host", F.array().cast("array<string>").alias("node"), "labels", own.alias("share")), "url-shares")
    final, done, depth = shapes, None, 0
    while True:
        # leaves of this depth take their node's share, as all below a node without labels; the others go one segment down
        placed = stored(final.join(shares.withColumnRenamed("labels", "known"), ["host", "node"]), "url-placed")
        ends = (F.size("segments") == depth) | (F.col("known") == 0)
        here = placed.where(ends).select("host", "segments", "share")
        done = here if done is None else done.unionByName(here)
        final = placed.where(~ends).drop("share", "known").withColumn("child", F.element_at("segments", depth + 1))
        if final.isEmpty():
            return done
        children = stored(final.groupBy("host", "node", "child").agg(*sums), "url-children")
        below = F.concat("node", F.array(F.when(F.col("constant"), F.col("child")).otherwise(F.lit(ANY))))
        final = final.join(stored(_constant(children), "url-constant"), ["host", "node", "child"]).select(
            "host", "segments", "urls", "labels", "blocked", F.col("node").alias("parent"), below.alias("node"))
        final = stored(final, "url-nodes")
        nodes = stored(final.groupBy("host", "parent", "node").agg(*sums), "url-siblings")
        shares = _smoothed(nodes, shares.withColumnRenamed("node", "parent"), ["host", "parent"]).select("host", "node", "labels", "share")
        final = final.drop("parent")
        depth += 1


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "{n}"), "/", -1), lambda s: s != "")
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), says.alias("verdict"), segments.alias("segments"))
    shares = stored(template_shares(rows), "url-templates")
    joined = rows.join(shares, ["host", "segments"], "left")
    by_template = F.when(F.col("share") > REJECT, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_template).alias("verdict"))
