"""URL filter by a tree of path templates for each host.

A path is taken apart into segments. Level by level, a segment of a host and parent template keeps its own
branch only if it is frequent there and its share of bad labels differs from its siblings'; all variable
segments become one wildcard. Branches that were kept but whose labels are statistically alike are merged into
one, which is named after all of them. A template is rejected if its smoothed share of good labels is too small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored, union_all

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class TreeConfig:
    """``min_rows``, ``min_share``: rows a branch needs, in number and as a share of its parent, to stay apart.
    ``min_z``: standard errors between its share of bad labels and its siblings'. ``prior``: labels' worth of the host's share that smooths a template's, and of the
    overall share that smooths a host's. ``min_purity``: smoothed share of good labels below which is rejected.
    """

    min_rows: int = 5
    min_share: float = 0.02
    min_z: float = 1.96
    prior: float = 5.0
    min_purity: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path without query and fragment; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule, written host + path, that fits; null if none does. A rule covers subdomains."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def wildcard(segment: Column) -> Column:
    """The wildcard of a segment keeps only its file ending."""
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"\.[A-Za-z]{1,5}$", 0))


def _counts() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]


def merged_branches(kept: DataFrame, config: TreeConfig) -> DataFrame:
    """Rows (host, template, segment, literal): the name that each kept branch goes on under.

    Siblings are walked through in order of their share of bad labels; one that does not differ from the branches
    merged so far joins them. A merged branch has the names of all with ``#`` between, which no path holds. A parent
    has at most 1 / ``min_share`` kept branches, so what is gathered is bounded.
    """
    share = F.col("bad") / F.col("labelled")
    sibling = F.struct(share.alias("share"), F.array("segment").alias("names"), "labelled", "bad")
    gathered = kept.groupBy("host", "template").agg(F.sort_array(F.collect_list(sibling)).alias("siblings"))

    def step(done: Column, one: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        labelled, bad = last["labelled"] + one["labelled"], last["bad"] + one["bad"]
        pooled = bad / labelled
        spread = F.sqrt(pooled * (1 - pooled) * (1 / last["labelled"] + 1 / one["labelled"]))
        alike = F.abs(one["bad"] / one["labelled"] - last["bad"] / last["labelled"]) < config.min_z * spread
        alike = F.coalesce(alike | (last["bad"] * one["labelled"] == one["bad"] * last["labelled"]), F.lit(False))
        both = F.struct(F.concat(last["names"], one["names"]).alias("names"), labelled.alias("labelled"), bad.alias("bad"))
        own = F.struct(one["names"].alias("names"), one["labelled"].alias("labelled"), one["bad"].alias("bad"))
        return F.when(alike, F.array_append(F.slice(done, 1, F.size(done) - 1), both)).otherwise(F.array_append(done, own))

    nothing = F.array().cast("array<struct<names:array<string>,labelled:bigint,bad:bigint>>")
    merged = gathered.select("host", "template", F.explode(F.aggregate("siblings", nothing, step)).alias("merged"))
    name = F.array_join(F.array_sort("merged.names"), "#")
    return merged.select("host", "template", F.explode("merged.names").alias("segment"), name.alias("literal"))


def path_tree(urls: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """Rows (host, path, template, n, labelled, bad), one for each distinct host and path of ``urls``.

    ``urls`` has host, path and bad (boolean, null: not labelled). Equal paths are counted first; after that
    each level groups and joins counts by host, parent and segment, so a host with a third of all rows is
    many groups, and its sums are combined before the shuffle. Levels go on as long as a parent has the rows that
    a branch needs; below, every segment is a wildcard whatever its depth, so what is left is named at once.
    """
    paths = stored(
        urls.groupBy("host", "path").agg(
            F.count("*").alias("n"), F.count("bad").alias("labelled"),
            F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"),
        ), "paths",
    )
    split = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    work = paths.select("*", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(split).alias("segments"), F.lit("").alias("template"))
    done, level = [], 0
    while True:
        done.append(work.where(F.size("segments") <= level))
        current = work.where(F.size("segments") > level).withColumn("segment", F.col("segments")[level])
        branches = stored(current.groupBy("host", "template", "segment").agg(*_counts()), "branches")
        parents = stored(
            branches.groupBy("host", "template").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "bad")]), "parents"
        )
        if (parents.agg(F.max("all_n")).first()[0] or 0) < config.min_rows:
            rest = F.transform(F.slice("segments", level + 1, F.size("segments")), lambda segment: F.concat(F.lit("/"), wildcard(segment)))
            done.append(current.withColumn("template", F.concat("template", F.array_join(rest, ""))).drop("segment"))
            break
        others, others_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.col("all_labelled")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / others))
        apart = (
            F.when((F.col("labelled") > 0) & (others > 0) & (pooled > 0) & (pooled < 1),
                   F.abs(F.col("bad") / F.col("labelled") - others_bad / others) >= config.min_z * spread)
            .otherwise(F.lit(False))
        )
        kept = (
            branches.join(parents, ["host", "template"])
            .where((F.col("n") >= config.min_rows) & (F.col("n") >= config.min_share * F.col("all_n")) & apart)
            .select("host", "template", "segment", "labelled", "bad")
        )
        name = F.coalesce("literal", wildcard(F.col("segment")))
        work = stored(
            current.join(merged_branches(kept, config), ["host", "template", "segment"], "left")
            .withColumn("template", F.concat("template", F.lit("/"), name)).drop("literal", "segment"), "tree",
        )
        level += 1
    return union_all(done).select("host", "path", "template", "n", "labelled", "bad")


def judged_templates(tree: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """Rows (host, template, purity, rejected): good labels' share, smoothed by the host's, that by the overall."""
    total = tree.agg(F.sum("labelled"), F.sum("bad")).first()
    overall = (total[1] or 0) / total[0] if total[0] else 0.0
    templates = tree.groupBy("host", "template").agg(*_counts())
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("of_host"), F.sum("bad").alias("bad_of_host"))
    a = config.prior
    host_share = (F.col("bad_of_host") + a * overall) / (F.col("of_host") + a)
    purity = 1 - (F.col("bad") + a * host_share) / (F.col("labelled") + a)
    return templates.join(hosts, "host").select(
        "host", "template", purity.alias("purity"), (purity < config.min_purity).alias("rejected")
    )


def filter_urls(pages: DataFrame, labels: DataFrame, rules: dict[str, str], config: TreeConfig = TreeConfig()) -> DataFrame:
    """Rows (page_id, host, path, rule, template, purity, verdict) for every row of ``pages`` (page_id, url).

    ``labels`` has rows (page_id, bad); of several labels of a page one bad one counts. A rule (host + path, to
    ``allow`` or ``block``) goes before the tree. A null url or one without ``://`` has an empty host and path
    and is judged by that host's labels. Repeated pages stay repeated; an empty table gives no rows.
    Pages with a null page_id stay, without a label.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    tree = stored(path_tree(parsed.join(known, "page_id", "left"), config), "path-tree")
    judged = stored(judged_templates(tree, config), "templates")
    by_path = stored(tree.join(judged, ["host", "template"]).select("host", "path", "template", "purity", "rejected"), "paths-judged")
    verdict = F.when(F.col("rejected"), "block").otherwise("allow")
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(what)).otherwise(verdict)
    return (
        parsed.join(by_path, ["host", "path"])
        .withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", "rule", "template", "purity", verdict.alias("verdict"))
    )
