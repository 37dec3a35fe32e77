"""URL verdicts: host and path rules first, else the purity of the url's template.

Per host, paths form a tree of segments. Segments that look variable (digits, identifiers) are
generalised at once; then, level by level from the root, a branch becomes a wildcard if its
node has too many children to be names and the branch is small, or if its rate of rejected
pages does not differ from that of its siblings by a two-proportion test. What is left of a
path is its template, judged by its labelled pages: the share of good ones, smoothed towards
the share over all pages, must reach a threshold.

All on DataFrame functions. Pages are counted per distinct generalised path first; the tree is
built on those counts, so a host with a third of all pages is a few counted rows. Only one
row, the overall rate, reaches the driver.

A null url, or one without ``://``, has an empty host and path, which is a template like any
other. Repeated rows count as often as they occur and come out as often. Labels that are null
count as missing. Levels are built until every path has ended or is alone in its branch, where
nothing can be merged any more. Empty tables give empty results.
Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage

#: (rule, verdict): host and start of path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: A node with more children than this has variable children; those with less than this share of its pages are merged.
MAX_CHILDREN = 32
MIN_SHARE = 0.05
#: Branches whose rates differ by fewer standard errors are alike.
ALIKE = 2.58
#: Weight, in pages, of the overall rate in a template's purity.
PRIOR_PAGES = 8.0
MIN_PURITY = 0.5

WILDCARD = "*"
# What no path holds.
_END = "?"


def host_of(url: str | Column = "url") -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str | Column = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """Longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest is asked first, so it is put on last.
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """The path with numbers as ``#`` and identifiers as ``{id}``."""
    numbers = F.regexp_replace(_lower(path), "[0-9]+", "#")
    return F.regexp_replace(numbers, "[^/#]*#[^/#]+#[^/]*", "{id}")


def _segment(level: int) -> Column:
    """Segment of ``shape`` at a level, from 0; a mark where the path has ended."""
    parts = F.split("shape", "/", -1)
    return F.coalesce(F.get(parts, F.lit(level)), F.lit(_END))


def _generalised(paths: DataFrame, level: int) -> DataFrame:
    """``paths`` with one more segment in ``template``, its own or a wildcard, and ``done`` where none follows.

    A path alone in its node has all its segments at once.
    """
    node = ["host", "template"]
    paths = paths.withColumn("segment", _segment(level))
    children = paths.groupBy(*node, "segment").agg(F.count("*").alias("shapes"), *[F.sum(c).alias(c) for c in ("pages", "labelled", "rejected")])
    nodes = children.groupBy(*node).agg(
        F.count("*").alias("children"), (F.sum("shapes") == 1).alias("alone"),
        F.sum("pages").alias("all_pages"), F.sum("labelled").alias("all_labelled"), F.sum("rejected").alias("all_rejected"),
    )
    own, rest = F.col("labelled"), F.col("all_labelled") - F.col("labelled")
    rate = F.try_divide("all_rejected", "all_labelled")
    spread = F.sqrt(rate * (1 - rate) * (F.try_divide(F.lit(1.0), own) + F.try_divide(F.lit(1.0), rest)))
    gap = F.try_divide(F.col("rejected"), own) - F.try_divide(F.col("all_rejected") - F.col("rejected"), rest)
    differs = F.abs(gap) > F.lit(ALIKE) * spread
    variable = (F.col("children") > MAX_CHILDREN) & (F.col("pages") < F.lit(MIN_SHARE) * F.col("all_pages"))
    only = F.col("children") == 1
    keeps = only | (~variable & (own > 0) & (rest > 0) & (F.col("all_rejected") > 0) & (F.col("all_rejected") < F.col("all_labelled")) & differs)
    named = children.join(nodes, node).select(
        *node, "segment", "alone", F.when((F.col("segment") == _END) | F.coalesce(keeps, F.lit(False)), F.col("segment")).otherwise(WILDCARD).alias("kept")
    )
    parts = F.split("shape", "/", -1)
    rest = F.array_join(F.slice(parts, level + 1, F.size(parts)), "/")
    added = F.concat("template", F.lit("/" if level else ""), F.when(F.col("alone"), rest).otherwise(F.col("kept")))
    return paths.join(named, [*node, "segment"]).select(
        "host", "shape", F.when(F.col("segment") == _END, F.col("template")).otherwise(added).alias("template"),
        "pages", "labelled", "rejected", (F.col("alone") | (F.col("segment") == _END)).alias("done"),
    )


def template_tree(counted: DataFrame) -> DataFrame:
    """(host, shape, template, counts) of ``counted`` (host, shape, pages, labelled, rejected)."""
    columns = ["host", "shape", "template", "pages", "labelled", "rejected"]
    paths = counted.withColumn("template", F.lit("")).select(columns)
    # A path starts with a slash, so its first segment is empty.
    level, finished = 0, paths.limit(0)
    while True:
        grown = cut_lineage(_generalised(paths, level))
        finished = finished.unionByName(grown.where("done").select(columns))
        paths, level = grown.where(~F.col("done")).select(columns), level + 1
        if paths.isEmpty():
            return finished


def purity(templates: DataFrame, prior: float) -> DataFrame:
    """(host, template, labelled, purity): share of good pages, smoothed towards ``prior``."""
    counted = templates.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("rejected").alias("rejected"))
    good = F.col("labelled") - F.col("rejected")
    return counted.select("host", "template", "labelled", ((good + F.lit(PRIOR_PAGES * prior)) / (F.col("labelled") + F.lit(PRIOR_PAGES))).alias("purity"))


def judge_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row per row of ``pages``.

    ``labels``: (number bigint, rejected boolean). A page is labelled by the last number in its path.
    """
    host, path = host_of(), path_of()
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("shape", shape_of(F.col("path")))
    number = F.regexp_extract("path", "([0-9]{1,18})[^0-9]*$", 1)
    numbered = urls.select("host", "shape", F.when(number != "", number.cast("bigint")).alias("number")).where(F.col("number").isNotNull())
    known = labels.where(F.col("number").isNotNull() & F.col("rejected").isNotNull()).groupBy("number").agg(F.max(F.col("rejected").cast("int")).alias("rejected"))
    marked = numbered.join(known, "number").groupBy("host", "shape").agg(F.count("*").alias("labelled"), F.sum("rejected").alias("rejected"))
    counted = cut_lineage(
        urls.groupBy("host", "shape").agg(F.count("*").alias("pages")).join(marked, ["host", "shape"], "left").fillna(0, ["labelled", "rejected"])
    )
    labelled, rejected = counted.agg(F.sum("labelled"), F.sum("rejected")).first()
    prior = 1 - rejected / labelled if labelled else 1.0
    templates = template_tree(counted)
    judged = templates.select("host", "shape", "template").join(purity(templates, prior), ["host", "template"])
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    fallback = F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")
    return urls.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, fallback).alias("verdict"), "template", "purity"
    )
