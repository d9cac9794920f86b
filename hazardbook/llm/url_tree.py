"""URL filter over a path-template tree.

The paths of every host form a tree of segments. Segments with a digit are variable;
so is a branch of too few pages for its own rate. Variable segments
become wildcards, which leaves templates such as ``/fr/*``. Sibling templates, which
differ in their last fixed segment, are merged when their labelled rates do not differ
by more than chance. A template is rejected when its smoothed share of blocked labels
exceeds a half; smoothing leans on the same template over all hosts, and that on the
share over all labels. The labels are the pages that a given rule decides.

Defined results: a null url, or one without ``://``, has empty host and path; the root
path is the template ``/``; paths are followed to their end; an empty table gives no rows; with no labels at all nothing is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.session import stage

# A branch with fewer pages than the prior counts for is variable, however many pages
# or branches its parent has.
LEAST_PAGES = 4
# Siblings whose rates differ by fewer standard errors are one branch.
MERGE_Z = 2.0
# Rates are merged by bins; a bin ends at REJECT_ABOVE, so none holds both verdicts.
BINS = 64
# Labels that the next wider rate counts for.
PRIOR = 4.0
REJECT_ABOVE = 0.5


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the beginning of the path."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, else null. For rule lists of a length
    that a plan can hold."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The path's segments, those with a digit as ``*``."""
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/")
    return F.transform(segments, lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))


def _count(n: str) -> Column:
    return F.sum(n).alias(n)


def templates(shapes: DataFrame) -> DataFrame:
    """(host, shape) with its ``template``: level by level, branches of too few pages
    become wildcards. A level is written before the next one reads it. A shape is done
    when it ends, when too few pages share its template for any further branch, or when
    it is the only one there; so the levels end with the last parent that has a choice."""
    step, done, depth = stage(shapes.withColumn("template", F.lit(""))), [], 0
    while True:
        here = step.withColumn("segment", F.element_at("shape", depth + 1))
        kept = here.groupBy("host", "template", "segment").agg(_count("n")).where(
            (F.col("n") >= LEAST_PAGES) | (F.col("segment") == "")
        ).select("host", "template", "segment", F.lit(True).alias("kept"))
        branch = F.when(F.col("kept"), F.col("segment")).otherwise("*")
        grown = here.join(kept, ["host", "template", "segment"], "left").withColumn(
            "template", F.concat("template", F.lit("/"), branch)
        ).drop("segment", "kept").withColumn("rest", F.slice("shape", depth + 2, F.greatest(F.size("shape"), F.lit(1))))
        parents = grown.where(F.size("rest") > 0).groupBy("host", "template").agg(
            F.sum("n").alias("all"), F.count("*").alias("shapes")
        )
        few, ends = F.col("all") < LEAST_PAGES, F.size("rest") == 0
        wild = F.transform("rest", lambda x: F.when(few & (x != ""), "*").otherwise(x))
        goes_on = ~ends & ~few & (F.col("shapes") > 1)
        level = stage(
            grown.join(parents, ["host", "template"], "left").withColumn("open", goes_on).withColumn(
                "template",
                F.when(ends | F.col("open"), F.col("template")).otherwise(
                    F.concat("template", F.lit("/"), F.array_join(wild, "/"))
                ),
            ).drop("rest", "all", "shapes")
        )
        done.append(level.where("NOT open").drop("open"))
        step, depth = level.where("open").drop("open"), depth + 1
        if step.isEmpty():
            return reduce(DataFrame.unionByName, done)


def merged(rated: DataFrame) -> DataFrame:
    """Sibling templates with a ``branch``: in the order of their rates, each is held
    against the pooled rate of the branch so far, and begins the next branch if it lies
    beyond chance. Templates whose rates share one of ``BINS`` bins are taken together,
    so a family is a row of that length, however many templates it has. A template
    without labels has no branch; it neither joins others nor links them."""
    binned = rated.withColumn("bin", F.when(F.col("labelled") > 0, F.ceil(F.col("rate") * BINS)))
    bins = binned.where("bin IS NOT NULL").groupBy("host", "family", "bin").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
        F.sum("prior").alias("prior"), F.count("*").alias("k"),
    )

    def rate(x: Column) -> Column:
        return (x["blocked"] + PRIOR * x["prior"] / x["k"]) / (x["labelled"] + PRIOR)

    def variance(x: Column) -> Column:
        return rate(x) * (1 - rate(x)) / (x["labelled"] + PRIOR)

    def take(held: Column, x: Column) -> Column:
        apart = rate(x) - rate(held) > MERGE_Z * F.sqrt(variance(x) + variance(held))
        starts = (F.size(held["told"]) == 0) | apart
        pooled = [
            F.when(starts, x[c]).otherwise(held[c] + x[c]).alias(c) for c in ("labelled", "blocked", "prior", "k")
        ]
        branch = F.when(starts, x["bin"]).otherwise(held["branch"])
        told = F.concat(held["told"], F.array(F.struct(x["bin"].alias("bin"), branch.alias("branch"))))
        return F.struct(*pooled, branch.alias("branch"), told.alias("told"))

    none = F.expr(
        "named_struct('labelled', 0L, 'blocked', 0L, 'prior', 0D, 'k', 1L, 'branch', 0L,"
        " 'told', CAST(array() AS array<struct<bin: bigint, branch: bigint>>))"
    )
    row = F.array_sort(F.collect_list(F.struct("bin", "labelled", "blocked", "prior", "k")))
    told = bins.groupBy("host", "family").agg(row.alias("bins")).select(
        "host", "family", F.explode(F.aggregate("bins", none, take)["told"]).alias("told")
    ).select("host", "family", "told.bin", "told.branch")
    return binned.join(told, ["host", "family", "bin"], "left").drop("bin")


def judge(pages: DataFrame, url: str, keep: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """``keep`` columns with ``host``, ``path``, ``rule``, ``template``, ``verdict`` and
    the ``purity`` (smoothed share of blocked labels) of the template."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    allowed = [r.text for r in rules if r.allow]
    found = pages.select(*[F.col(c).alias(f"__{c}") for c in keep], host.alias("host"), path.alias("path"))
    found = found.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    found = found.withColumn("shape", shape_of(F.col("path")))
    # Pages are counted by shape first, so the tree is built from few rows.
    shapes = found.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count("rule").alias("labelled"),
        F.count(F.when(~F.col("rule").isin(allowed), 1)).alias("blocked"),
    )
    tree = templates(shapes)
    counted = tree.groupBy("host", "template").agg(_count("labelled"), _count("blocked"))
    overall = counted.agg(
        ((F.coalesce(F.sum("blocked"), F.lit(0)) + 1) / (F.coalesce(F.sum("labelled"), F.lit(0)) + 2)).alias("base")
    )
    wide = counted.groupBy("template").agg(
        F.sum("labelled").alias("wide_labelled"), F.sum("blocked").alias("wide_blocked")
    ).join(F.broadcast(overall)).withColumn(  # one row
        "prior", (F.col("wide_blocked") + PRIOR * F.col("base")) / (F.col("wide_labelled") + PRIOR)
    )
    rated = counted.join(wide.select("template", "prior"), "template").withColumn(
        "rate", (F.col("blocked") + PRIOR * F.col("prior")) / (F.col("labelled") + PRIOR)
    ).withColumn(
        "family", F.regexp_replace("template", r"[^/*]+((?:/\*)*/?)$", "?$1")
    )
    branches = merged(rated)
    purity = branches.where("branch IS NOT NULL").groupBy("host", "family", "branch").agg(
        ((F.sum("blocked") + PRIOR * F.avg("prior")) / (F.sum("labelled") + PRIOR)).alias("purity")
    )
    scored = branches.join(purity, ["host", "family", "branch"], "left").select(
        "host", "template", F.coalesce("purity", "prior").alias("purity")
    )
    by_shape = tree.select("host", "shape", "template").join(scored, ["host", "template"])
    by_rule = F.when(F.col("rule").isin(allowed), "allow").when(F.col("rule").isNotNull(), "block")
    by_template = F.when(F.col("purity") > REJECT_ABOVE, "block").otherwise("allow")
    return found.join(by_shape, ["host", "shape"], "left").select(
        *[F.col(f"__{c}").alias(c) for c in keep], "host", "path", "rule", "template", "purity",
        F.coalesce(by_rule, by_template).alias("verdict"),
    )
