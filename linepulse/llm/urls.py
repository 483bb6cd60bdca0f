"""URL filter: a tree of path templates for each host, judged by the labels of its pages.

Segments of a known variable form (numbers, long hexadecimal, dates) become a wildcard at once.
Then the tree is walked from the root: where a node has many children, the rare ones are variable
and become the wildcard, but for those whose labels tell them apart from what they would join.
Afterwards, from the leaves to the root, branches that differ in one segment are merged if their
labels don't tell them apart. Both are a test of proportions against the merged branch. A template
whose smoothed share of good labels is low is rejected.

The steps run on one row for each host and form of path. Counts are aggregates joined back by
host and branch, so that a host with a third of all pages isn't gathered in one place. Paths have
any number of segments; a level is worked on only where it can change something.

Null urls and urls without "://" have an empty host and path. Addresses of any length are read whole. Repeated
rows are judged alike, and each counts. Of rules that fit the longest wins, of equally long ones the later; a share that is
exactly the least purity is allowed. Without labels the share is the prior. An empty table gives no
rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(name: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of the url in a column."""
    rest = F.coalesce(
        F.when(F.instr(name, "://") > 0, F.expr(f"substring({name}, instr({name}, '://') + 3)")),
        F.lit(""),
    )
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict, else null. rules: (verdict, host/path)."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        text = F.when(fits, F.lit(rule)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _form(path: Column) -> Column:
    """Segments of a path, with a wildcard for those of a variable form."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(
        parts,
        lambda s: F.regexp_replace(
            F.regexp_replace(s, r"[0-9a-fA-F]{12,}|[0-9a-fA-F-]{32,}", "*"), r"[0-9]+", "*"
        ),
    )


def _far(z: float) -> Column:
    """Is a branch (_good, _bad) told apart by its labels from the merged one (_g, _b)?"""
    share = F.try_divide(F.col("_g"), F.col("_g") + F.col("_b"))
    seen = F.col("_good") + F.col("_bad")
    far = F.abs(F.col("_good") - seen * share) > z * F.sqrt(seen * share * (1 - share))
    return F.coalesce(far & (seen > 0), F.lit(False))


def templates(
    paths: DataFrame,
    most_children: int = 20,
    rare: float = 0.02,
    z: float = 2.0,
    least_labels: int = 5,
) -> DataFrame:
    """Adds `template` to rows of host, form (segments), n, good and bad.

    Rare children with fewer than `least_labels` labels are too few for the test of proportions.
    """
    rows = materialize(paths.withColumn("template", F.col("form")), "forms")
    # a node has no more children than its host has different segments at that level
    segments = rows.select("host", F.posexplode("form")).groupBy("host", "pos", "col").count()
    wide = segments.groupBy("host", "pos").count().where(F.col("count") > most_children)
    for k in _levels(wide):
        rest, rows = rows.where(F.size("form") < k), rows.where(F.size("form") >= k)
        rows = rows.withColumn("_at", F.array_join(F.slice("template", 1, k - 1), "/")).withColumn(
            "_own", F.get("template", F.lit(k - 1))
        )
        children = rows.groupBy("host", "_at", "_own").agg(
            F.sum("n").alias("_n"), F.sum("good").alias("_good"), F.sum("bad").alias("_bad")
        )
        nodes = children.groupBy("host", "_at").agg(
            F.sum("_n").alias("_all"), F.count("*").alias("_children")
        )
        wild = F.col("_own") == "*"  # what becomes the wildcard joins it
        joining = children.join(nodes, ["host", "_at"]).where(
            (F.col("_children") > most_children) & (wild | (F.col("_n") < rare * F.col("_all")))
        )
        pooled = joining.groupBy("host", "_at").agg(
            F.sum("_good").alias("_g"), F.sum("_bad").alias("_b")
        )
        own_branch = _far(z) & (F.col("_good") + F.col("_bad") >= least_labels)
        rare_ones = (
            joining.join(pooled, ["host", "_at"])
            .where(wild | ~own_branch)
            .select("host", "_at", "_own", F.lit(True).alias("_rare"))
        )
        rows = rows.join(rare_ones, ["host", "_at", "_own"], "left").withColumn(
            "template", F.when(F.col("_rare"), _starred(k)).otherwise(F.col("template"))
        )
        rows = materialize(rows.drop("_at", "_own", "_rare").unionByName(rest), "forms")
    # only templates of one length merge; where all have the same segment, each merges with itself
    length = F.size("template").alias("_size")
    varied = (
        rows.select("host", length, F.posexplode("template"))
        .groupBy("host", "_size", "pos")
        .agg(F.min("col").alias("_least"), F.max("col").alias("_most"))
        .where("_least < _most")
    )
    varied = materialize(varied.select("host", "_size", "pos"), "varied")
    places = varied.groupBy("host", "_size").agg(F.collect_set("pos").alias("_varied"))
    rows = rows.withColumn("_size", length).join(places, ["host", "_size"], "left").withColumn(
        "template",
        F.when(F.col("_varied").isNull(), F.transform("template", lambda s: F.lit("*"))).otherwise(
            F.transform(
                "template",
                lambda s, i: F.when(F.array_contains("_varied", i), s).otherwise("*"),
            )
        ),
    )
    rows = materialize(rows.drop("_size", "_varied"), "forms")
    for k in reversed(_levels(varied)):
        rest, rows = rows.where(F.size("form") < k), rows.where(F.size("form") >= k)
        rows = rows.withColumn("_merged", _starred(k))
        branch = rows.groupBy("host", "_merged", "template").agg(
            F.sum("good").alias("_good"), F.sum("bad").alias("_bad")
        )
        pooled = branch.groupBy("host", "_merged").agg(
            F.sum("_good").alias("_g"), F.sum("_bad").alias("_b")
        )
        apart = (
            branch.join(pooled, ["host", "_merged"])
            .where(_far(z))
            .select("host", "_merged", "template", F.lit(True).alias("_apart"))
        )
        rows = rows.join(apart, ["host", "_merged", "template"], "left").withColumn(
            "template",
            F.when(F.col("_apart"), F.col("template")).otherwise(F.col("_merged")),
        )
        rows = materialize(rows.drop("_merged", "_apart").unionByName(rest), "forms")
    return rows


def _levels(places: DataFrame) -> list[int]:
    """The different levels (from 1) of rows with a segment's place."""
    return sorted(r[0] + 1 for r in places.select("pos").distinct().collect())


def _starred(k: int) -> Column:
    """The template with a wildcard as segment k."""
    t = F.col("template")
    return F.concat(F.slice(t, 1, k - 1), F.array(F.lit("*")), F.slice(t, k + 1, F.greatest(F.size(t) - k, F.lit(0))))


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[tuple[str, str]],
    least_purity: float = 0.5,
    strength: float = 10.0,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every page.

    labelled: url and good (boolean) of the pages with labels; repeated rows count repeatedly.
    """

    def parsed(df: DataFrame, *columns: str) -> DataFrame:
        df = df.withColumn("_url", F.col("url").cast("string"))
        host, path = split_url("_url")
        df = df.select(*columns, host.alias("host"), path.alias("path"))
        return df.withColumn("form", _form(F.col("path")))

    own = parsed(pages.withColumn("page_id", F.col("page_id").cast("bigint")), "page_id")
    taught = parsed(labelled.where("good is not null"), "good")
    counts = (
        own.select("host", "form", F.lit(1).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("bad"))
        .union(
            taught.select(
                "host",
                "form",
                F.lit(0).alias("n"),
                F.col("good").cast("int"),
                (~F.col("good")).cast("int").alias("bad"),
            )
        )
        .groupBy("host", "form")
        .agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    )
    rows = templates(counts)
    good, bad = rows.agg(F.sum("good"), F.sum("bad")).first()
    prior = ((good or 0) + 1) / ((good or 0) + (bad or 0) + 2)
    sums = rows.groupBy("host", "template").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    purity = (F.col("g") + strength * prior) / (F.col("g") + F.col("b") + strength)
    judged = rows.join(sums, ["host", "template"]).select(
        "host", "form", F.array_join("template", "/").alias("template"), purity.alias("purity")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own_verdict = F.when(F.col("purity") < least_purity, "block").otherwise("allow")
    return own.join(judged, ["host", "form"]).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, own_verdict).alias("verdict"),
        "template",
        "purity",
    )
