"""URL filters: a path-template tree per host, with labelled purity deciding what rules do not.

The tree is built over the distinct paths of a host.  Level by level, a segment stays literal where at least SUPPORT distinct
paths go on below it, whatever the size of its host; all others become a wildcard, down to the last segment that any path shares.
Sibling branches whose shares of blocked labels do not differ significantly are merged.  A branch is rejected by its purity, smoothed
towards the same template over all hosts, this towards all that stands below its parent over all hosts, and that towards a prior.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.scaling import attach
from .common import durable
from .licenses import LOWER, UPPER

# Verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SUPPORT = 4  # distinct paths below a literal segment
STRENGTH = 20.0  # labelled URLs that the smoothing counts as
ALIKE = 1.96  # z value up to which two branches are alike
PRIOR = 0.2  # share of blocked labels taken for granted where there are none
REJECT = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for URLs without `://`."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits host (or a domain above it) and path; nulls where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def templates(paths: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Distinct paths(host, path, ...) with parent and template: the path with its variable segments as `*`.

    One round a level, until no segment is shared by enough paths: from there on all segments are wildcards.
    """
    rows = paths.withColumns({"_segments": F.split(F.regexp_replace("path", "^/", ""), "/"), "template": F.lit(""), "parent": F.lit("")})
    level = 0
    while True:
        rows = durable(rows.withColumn("_segment", F.get("_segments", F.lit(level))))
        counts = rows.filter("_segment IS NOT NULL").groupBy("host", "template", "_segment").agg(F.count("*").alias("_n"))
        literal = durable(counts.filter(F.col("_n") >= support).drop("_n").withColumn("_literal", F.lit(True)))
        if literal.isEmpty():
            break
        rows = attach(rows, literal, ["host", "template", "_segment"], grown=True)
        name = F.when(F.col("_literal"), F.col("_segment")).otherwise("*")
        ended = F.col("_segment").isNull()
        rows = rows.withColumns({"parent": F.when(ended, F.col("parent")).otherwise(F.col("template")), "template": F.when(ended, F.col("template")).otherwise(F.concat("template", F.lit("/"), name))}).drop("_segment", "_literal")
        level += 1
    left = F.greatest(F.lit(0), F.size("_segments") - level)
    rest = lambda n: F.concat("template", F.repeat(F.lit("/*"), n))
    return rows.withColumns({"parent": F.when(left > 0, rest(left - 1)).otherwise(F.col("parent")), "template": rest(left)}).drop("_segments", "_segment")


def merge_alike(stats: DataFrame, alike: float = ALIKE) -> DataFrame:
    """stats(host, parent, template, blocked, labelled) with `branch`: siblings in order of purity, cut where neighbours differ significantly.

    A node's children are literal segments with paths of their own and a wildcard, so the window runs over templates, not URLs.
    """
    order = W.partitionBy("host", "parent").orderBy(F.col("blocked") / F.greatest("labelled", F.lit(1)), "template")
    b, n = F.lag("blocked").over(order), F.lag("labelled").over(order)
    pooled = (F.col("blocked") + b) / F.greatest(F.col("labelled") + n, F.lit(1))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest("labelled", F.lit(1)) + 1 / F.greatest(n, F.lit(1))))
    z = F.abs(F.col("blocked") / F.greatest("labelled", F.lit(1)) - b / F.greatest(n, F.lit(1))) / F.greatest(spread, F.lit(1e-9))
    cut = F.when((F.col("labelled") > 0) & (n > 0) & (z > alike), 1).when((F.col("labelled") > 0) != (n > 0), 1).otherwise(0)
    return stats.withColumn("_cut", cut).withColumn("branch", F.sum("_cut").over(order)).drop("_cut")


def judge(pages: DataFrame, rules=RULES, reject: float = REJECT, strength: float = STRENGTH, prior: float = PRIOR) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per row of pages(page_id, url).

    Labels are the rules' own verdicts, one for each distinct path.  Where no rule fits, a URL is blocked when its branch's smoothed
    share of blocked labels is above `reject`; without any label that share is `prior`.  Rows repeat as they are given; null URLs and
    those without `://` share the empty host and path; very long URLs are split whole.  Other columns are left behind, an empty table gives an empty one.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    paths = durable(templates(rows.select("host", "path").distinct().withColumn("rule", text).withColumn("ruled", verdict)))
    stats = paths.groupBy("host", "parent", "template").agg(F.count_if(F.col("ruled") == "block").alias("blocked"), F.count("ruled").alias("labelled"))
    stats = durable(merge_alike(stats))
    smooth = lambda b, n, towards: (b + strength * towards) / (n + strength)
    below = stats.groupBy("parent").agg(smooth(F.sum("blocked"), F.sum("labelled"), F.lit(prior)).alias("_below"))
    pooled = stats.groupBy("parent", "template").agg(F.sum("blocked").alias("_pb"), F.sum("labelled").alias("_pn")).join(below, "parent")
    pooled = pooled.select("parent", "template", smooth(F.col("_pb"), F.col("_pn"), F.col("_below")).alias("_pooled"))
    branch = stats.groupBy("host", "parent", "branch").agg(F.sum("blocked").alias("_b"), F.sum("labelled").alias("_n"))
    purity = attach(stats, pooled, ["parent", "template"], "inner").join(branch, ["host", "parent", "branch"])
    purity = purity.select("host", "template", smooth(F.col("_b"), F.col("_n"), F.col("_pooled")).alias("purity"))
    own = F.when(F.col("purity") > reject, "block").otherwise("allow")
    judged = attach(paths, purity.dropDuplicates(["host", "template"]), ["host", "template"])
    judged = judged.select("host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")
    return attach(rows, judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
