"""URL filters: rules, then a path-template tree judged by labelled purity.

A page whose host and path fit a rule gets the rule's verdict; such pages are
also the labels.  Every other page is judged by its path template.  Path segments are
generalised (digit runs, hexadecimal ids) and form a tree per host, and one over all hosts.

The trees are merged level by level.  Branches of a node that are alike become one wildcard
branch, and the next level is counted below the merged branch, so ``u/alice/spam`` and ``u/bob/spam`` meet
at ``u/*/spam``.  A branch with at least ``rare`` pages is alike if it and its siblings have ``rare`` labelled pages
each and their blocked shares do not differ (two-proportion test at 1.96).  A rarer one, a variable segment, is alike
unless the test says that its share differs from its siblings'; its share is that of the same segment at
the same level over all hosts.  A branch without siblings keeps its name.
A template's blocked share is smoothed towards
that of the same page's template over all hosts, which is smoothed towards the overall share;
a template above ``most`` is rejected.

DataFrame functions only.  Pages are pre-aggregated to (host, generalised path) before any tree work; there
are as many levels as paths share segments, and a path alone below its node is finished at once.
Null urls or urls without ``://`` have empty host and path and the empty template.  Repeated rows are counted and
judged each; very long paths are taken whole; equally long rules go to the longer host.  Without labelled pages every share
is 0, so nothing is rejected.  An empty table gives no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventide.plans.lineage import materialize

#: (verdict, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules=None) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    found = None
    for verdict, h, p in sorted(rules or RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]))):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def segment(s: Column) -> Column:
    return (F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike("^[0-9a-fA-F-]{16,}$"), F.lit("{hex}"))
            .otherwise(F.regexp_replace(s, "[0-9]+", "{n}")))


def general_path(path: Column) -> Column:
    """Generalised segments joined by ``/``."""
    return F.array_join(F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), segment), "/")


def unlike(l: Column, b: Column, rest_l: Column, rest_b: Column) -> Column:
    """Whether two blocked shares (b of l pages) differ in a two-proportion test at 1.96; no pages: they do not."""
    l, b, rest_l, rest_b = (c.cast("double") for c in (l, b, rest_l, rest_b))
    one = F.lit(1.0)
    gap, share = F.try_divide(b, l) - F.try_divide(rest_b, rest_l), F.try_divide(b + rest_b, l + rest_l)
    return F.coalesce(gap * gap > F.lit(3.8416) * share * (one - share) * (F.try_divide(one, l) + F.try_divide(one, rest_l)),
                      F.lit(False))


def templates(paths: DataFrame, seen: DataFrame, rare: int) -> DataFrame:
    """(scope, t, template) for ``paths`` (scope, t, n, l, b: pages, labelled, blocked); ``seen`` has them by host."""
    sums = [F.sum(c).alias(c) for c in ("n", "l", "b")]
    anywhere = materialize(seen.select("l", "b", F.posexplode(F.split("t", "/")).alias("d", "seg"))
                           .groupBy("d", "seg").agg(F.sum("l").alias("sl"), F.sum("b").alias("sb")), "url-segments")
    done = [paths.filter("t = ''").select("scope", "t", F.lit("").alias("template"))]
    left = paths.filter("t <> ''").select("scope", "t", "n", "l", "b", F.split("t", "/").alias("segs"), F.lit("").alias("prefix"))
    d = 0
    while not left.isEmpty():
        here = left.withColumn("seg", F.element_at("segs", d + 1))
        nodes = here.groupBy("scope", "prefix", "seg").agg(*sums, F.count(F.lit(1)).alias("paths"))
        family = nodes.groupBy("scope", "prefix").agg(F.sum("l").alias("fl"), F.sum("b").alias("fb"),
                                                      F.count(F.lit(1)).alias("kids"), F.sum("paths").alias("paths"))
        node = nodes.drop("paths").join(family, ["scope", "prefix"]).join(anywhere.filter(F.col("d") == d).drop("d"), "seg")
        rest = (F.col("fl") - F.col("l"), F.col("fb") - F.col("b"))
        wild = (F.when(F.col("kids") == 1, F.lit(False))
                .when(F.col("n") < rare, ~unlike(F.col("sl"), F.col("sb"), *rest))
                .otherwise((F.col("l") >= rare) & (rest[0] >= rare) & ~unlike(F.col("l"), F.col("b"), *rest)))
        node = node.select("scope", "prefix", "seg", "paths", F.when(wild, F.lit("*")).otherwise(F.col("seg")).alias("g"))
        alone = F.col("paths") == 1
        step = here.join(node, ["scope", "prefix", "seg"]).select(
            "scope", "t", "n", "l", "b", "segs", (alone | (F.size("segs") == d + 1)).alias("ended"),
            F.concat(F.col("prefix"), F.lit("/") if d else F.lit(""),
                     F.when(alone, F.array_join(F.slice("segs", d + 1, F.size("segs")), "/")).otherwise(F.col("g"))).alias("prefix"))
        step = materialize(step, "url-level")
        done.append(step.filter("ended").select("scope", "t", F.col("prefix").alias("template")))
        left = step.filter("NOT ended").drop("ended")
        d += 1
    return reduce(DataFrame.unionByName, done)


def judge(pages: DataFrame, rules=None, *, page_id: str = "page_id", url: str = "url", rare: int = 5,
          weight: float = 2.0, most: float = 0.5) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template, blocked_share."""
    rows = (pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
            .withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).withColumn("t", general_path(F.col("path"))))
    seen = rows.groupBy("host", "t").agg(F.count(F.lit(1)).alias("n"), F.count("r").alias("l"),
                                         F.count_if(F.col("r.verdict") == "block").alias("b"))
    seen = materialize(seen, "url-paths")
    paths = seen.select(F.concat(F.lit("h:"), "host").alias("scope"), "t", "n", "l", "b").unionByName(
        seen.groupBy("t").agg(*[F.sum(c).alias(c) for c in ("n", "l", "b")]).select(F.lit("all").alias("scope"), "t", "n", "l", "b"))
    paths = materialize(paths, "url-scopes")
    named = materialize(paths.join(templates(paths, seen, rare), ["scope", "t"]), "url-templates")
    total = seen.agg(F.sum("l").alias("l"), F.sum("b").alias("b")).first()
    base = F.lit(total["b"] / total["l"] if total["l"] else 0.0)
    purity = named.groupBy("scope", "template").agg(F.sum("l").alias("tl"), F.sum("b").alias("tb"))
    smooth = lambda towards: (F.col("tb") + F.lit(weight) * towards) / (F.col("tl") + F.lit(weight))
    overall = (named.filter("scope = 'all'").join(purity, ["scope", "template"])
               .select("t", smooth(base).alias("pg")))
    judged = (named.filter("scope <> 'all'").join(purity, ["scope", "template"]).join(overall, "t")
              .select(F.expr("substring(scope, 3)").alias("h"), F.col("t").alias("gt"), "template",
                      smooth(F.col("pg")).alias("blocked_share")))
    out = rows.join(judged, (F.col("host") == F.col("h")) & (F.col("t") == F.col("gt")))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                      F.coalesce(F.col("r.verdict"), F.when(F.col("blocked_share") > most, F.lit("block"))
                                 .otherwise(F.lit("allow"))).alias("verdict"), "template", "blocked_share")
