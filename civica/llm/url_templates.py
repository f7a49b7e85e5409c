"""URL filters from a path-template tree.

Per host the paths form a tree.  Level by level, a segment that at least
``min_support`` urls have at that place is a branch of its own; other segments
are variable and become a wildcard of their shape (``{num}``, ``{hex}``,
``{word}``, ``{str}``, with a common file ending kept).  Branches that differ
in one literal segment and whose labelled shares do not differ statistically
are merged, however many there are.  A template is rejected where its smoothed
share of bad labels is high.  Fixed rules come before that.

All of it is DataFrame functions.  Urls meet the branches of their place in an
equi-join on (host, template, segment), salted, so a host, a place or a branch
with most of the urls is spread.  The tree is as deep as ``min_support`` urls
share a place; below that no segment can be a branch, and the rest of a path
becomes wildcards at once.

Defined cases: a null url, or one without ``://``, has an empty host and path
and the template of the empty path; a path of any length and depth counts
whole; repeated rows count as often as they occur; branches of equal share are
ordered by their labelled urls, so ties have one result; without labels the
smoothed share is ``prior_bad``; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civica.llm.common import UPPER
from civica.session import cut_lineage

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ENDING = r"\.(?:html|htm|php|asp|aspx|jsp|pdf|xml|json)$"


@dataclass(frozen=True)
class TemplateSettings:
    """``min_support``: urls that a segment needs to be a branch.  ``z``: branches whose labelled shares are fewer standard errors apart are
    merged.  ``strength``: labels that the smoothing is worth."""

    min_support: int = 5
    z: float = 1.96
    strength: float = 10.0
    reject: float = 0.5
    prior_bad: float = 0.1
    salts: int = 16
    #: Literals that a merged branch is named by; more are counted.
    named: int = 8


def with_host_and_path(df: DataFrame, url_col: str) -> DataFrame:
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), UPPER, UPPER.lower())
    return df.withColumns({"host": host, "path": F.regexp_extract(url, URL, 2)})


def rule_verdict(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits, or
    nulls.  A rule fits its host and all subdomains, and paths that start
    with its path."""
    rule = verdict = F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """The wildcard of a variable segment."""
    ending = F.regexp_extract(segment, ENDING, 0)
    stem = F.regexp_replace(segment, ENDING, "")
    kind = F.when(stem == "", "").when(stem.rlike(r"^[0-9]+$"), "{num}") \
        .when(stem.rlike(r"^[0-9a-f-]{8,}$") & stem.rlike("[0-9]"), "{hex}") \
        .when(stem.rlike(r"^[A-Za-z]+$"), "{word}").otherwise("{str}")
    return F.concat(kind, ending)


def _salted(rows: DataFrame, table: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """Left join to a table with one row per key, which is repeated ``salts``
    times; the rows of a key are dealt out over the copies."""
    every = F.explode(F.array(*[F.lit(i) for i in range(salts)]))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("path", "_row"), F.lit(salts)).cast("int")) \
        .join(table.withColumn("_salt", every), [*keys, "_salt"], "left").drop("_salt")


def path_templates(rows: DataFrame, s: TemplateSettings = TemplateSettings()) -> DataFrame:
    """Adds ``template`` to ``rows`` (``host``, ``path``, ``_row``)."""
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = cut_lineage(rows.withColumn("_segments", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts))
                       .withColumn("template", F.lit("")), name="url-rows")
    level = 0
    while True:
        segment = F.get("_segments", F.lit(level))
        counts = cut_lineage(rows.select("host", "template", segment.alias("_segment")).filter("_segment is not null")
                             .groupBy("host", "template", "_segment").agg(F.count(F.lit(1)).alias("_n")), name="url-segments")
        if counts.groupBy("host", "template").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= s.min_support).isEmpty():
            break
        kept = counts.filter(F.col("_n") >= s.min_support).select("host", "template", "_segment", F.lit(True).alias("_kept"))
        joined = _salted(rows.withColumn("_segment", segment), kept, ["host", "template", "_segment"], s.salts)
        own = F.when(F.col("_kept"), F.col("_segment")).otherwise(shape(F.col("_segment")))
        step = F.when(F.col("_segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), own))
        rows = cut_lineage(joined.withColumn("template", step).drop("_segment", "_kept"), name="url-rows")
        level += 1
    rest = F.slice("_segments", level + 1, F.greatest(F.size("_segments") - level, F.lit(0)))
    shapes = F.aggregate(rest, F.col("template"), lambda t, x: F.concat(t, F.lit("/"), shape(x)))
    return rows.withColumn("template", shapes).drop("_segments")


def _split_last_literal(template: Column) -> tuple[Column, Column, Column]:
    """(before, literal, after): around the last segment without a wildcard;
    if there is none, the whole template before an empty literal."""
    last = r"^((?:.*/)?)([^/{}]+)((?:/[^/]*\{[^/]*|/)*)$"
    literal = F.regexp_extract(template, last, 2)
    none = literal == ""
    return (F.when(none, template).otherwise(F.regexp_extract(template, last, 1)), literal,
            F.when(none, "").otherwise(F.regexp_extract(template, last, 3)))


def template_verdicts(rows: DataFrame, s: TemplateSettings = TemplateSettings()) -> DataFrame:
    """One row per ``host, template``: the merged branch, its labelled urls,
    its smoothed share of bad ones and whether that rejects it.

    Branches are the literals at one place of the tree, with all templates
    below them.  Shares are smoothed from above: all urls, host, merged
    branch, template."""
    stats = rows.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad"))
    stats = cut_lineage(stats, name="url-templates")
    seen = stats.agg(F.sum("labelled"), F.sum("n_bad")).first()
    overall = (seen[1] + s.strength * s.prior_bad) / (seen[0] + s.strength) if seen[0] else s.prior_bad
    smooth = lambda prior: (F.sum("n_bad") + F.lit(s.strength) * prior) / (F.sum("labelled") + F.lit(s.strength))
    hosts = stats.groupBy("host").agg(smooth(F.lit(overall)).alias("host_share"))
    before, literal, after = _split_last_literal(F.col("template"))
    leaves = stats.withColumns({"before": before, "literal": literal, "after": after})
    branches = leaves.groupBy("host", "before", "literal").agg(F.sum("labelled").alias("labelled"), F.sum("n_bad").alias("n_bad"))
    # Branches of one place with equal counts are alike; the different counts, by share: where it rises by z standard
    # errors another group begins.  Half a label of each kind is added, for branches with few.
    place = ["host", "before"]
    counts = ["labelled", "n_bad"]
    alike = branches.groupBy(*place, *counts).agg(F.count(F.lit(1)).alias("times"))
    size = F.col("labelled") + 1.0
    by_share = Window.partitionBy(*place).orderBy("share", "labelled")
    alike = alike.withColumn("share", (F.col("n_bad") + 0.5) / size)
    last, last_size = F.lag("share").over(by_share), F.lag(size).over(by_share)
    pooled = (F.col("share") * size + last * last_size) / (size + last_size)
    error = F.sqrt(pooled * (1 - pooled) * (1 / size + 1 / last_size))
    apart = F.coalesce((F.col("share") - last) > F.lit(s.z) * error, F.lit(False))
    alike = cut_lineage(alike.withColumn("_apart", apart.cast("int")).withColumn("_group", F.sum("_apart").over(by_share)), name="url-branches")
    branches = branches.join(alike.select(*place, *counts, "_group"), [*place, *counts])
    group = [*place, "_group"]
    pooled_share = (F.sum(F.col("n_bad") * F.col("times")) + F.lit(s.strength) * F.first("host_share")) \
        / (F.sum(F.col("labelled") * F.col("times")) + F.lit(s.strength))
    merged = alike.join(hosts, "host").groupBy(group).agg(pooled_share.alias("branch_share"), F.sum("times").alias("times"))
    first = branches.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy("literal"))).filter(F.col("_rank") <= s.named) \
        .groupBy(group).agg(F.concat_ws("|", F.array_sort(F.collect_list("literal"))).alias("names"))
    more = F.when(F.col("times") > s.named, F.concat(F.lit("|+"), (F.col("times") - s.named).cast("string"))).otherwise("")
    merged = merged.join(first, group).select(*group, "branch_share", F.concat("names", more).alias("literals"))
    leaves = leaves.join(branches.select("host", "before", "literal", "_group"), ["host", "before", "literal"])
    key = [*group, "after"]
    judged = leaves.join(merged, group).groupBy(key).agg(
        F.sum("labelled").alias("merged_labelled"), smooth(F.first("branch_share")).alias("bad_share"), F.first("literals").alias("literals"))
    return leaves.select("template", *key).join(judged, key).select(
        "host", "template", F.concat("before", "literals", "after").alias("branch"), F.col("merged_labelled").alias("labelled"),
        "bad_share", (F.col("bad_share") >= s.reject).alias("rejected"))


def judge_urls(urls: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               bad_col: str = "bad", settings: TemplateSettings = TemplateSettings()) -> DataFrame:
    """Per url: its host, path, rule, verdict (the longest rule's; else
    ``block`` where its template is rejected, else ``allow``), the merged
    branch of its template, its labelled urls and smoothed share of bad ones.

    ``bad_col`` is 1 for a url known as bad, 0 for a good one, else null."""
    rows = with_host_and_path(urls.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url"),
                                          F.col(f"`{bad_col}`").cast("long").alias("bad")), "_url").drop("_url")
    rows = path_templates(rows.withColumn("_row", F.col("_id")), settings)
    found = _salted(rows, template_verdicts(rows, settings), ["host", "template"], settings.salts)
    rule, verdict = rule_verdict(rules)
    own = F.when(F.col("rejected"), "block").otherwise("allow")
    return found.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
                        F.coalesce(verdict, own).alias("verdict"), "branch", "labelled", "bad_share")
