"""URL filter: rules for hosts and paths, else the purity of a page's path template.

For each host the paths form a tree. Level by level, a segment stays as it is if it has
enough pages, however many its parent has; all others become one wildcard. Where fewer pages
than that go on, whatever follows is one wildcard too. Sibling branches whose labelled
purity does not differ significantly are merged. What is left is rejected if its purity,
smoothed towards that of all labelled pages, is too low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.tables import Stored

#: A literal segment has so many pages below its parent; so many go on to a next level.
LEAST_PAGES = 5
#: Levels that ``template`` shows.
MAX_DEPTH = 8
#: Standard errors that separate branches; weight of the overall purity; least purity.
APART, WEIGHT, LEAST_PURITY = 1.96, 20.0, 0.8

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in small letters and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _SMALL)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. A rule is (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _with_templates(pages: DataFrame) -> DataFrame:
    """Pages with their template; one round for each level that enough pages reach.

    A round reads the pages that go deeper and leaves the others where they are.
    """
    pages = pages.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != ""))
    pages = pages.withColumn("depth", F.size("segments")).withColumn("template", F.lit(""))
    level, at = Stored(pages, "templates").df, 0
    placed = level.filter("depth = 0")
    while not (here := level.filter(F.size("segments") > at)).isEmpty():
        here = here.withColumn("segment", F.element_at("segments", at + 1))
        children = here.groupBy("host", "template", "segment").agg(F.count(F.lit(1)).alias("n"))
        literal = children.filter(F.col("n") >= LEAST_PAGES).select("host", "template", "segment", F.lit(True).alias("literal"))
        following = here.join(literal, ["host", "template", "segment"], "left")
        # Nothing below so few pages is literal: they end here, at any depth.
        few = children.groupBy("host", "template").agg((F.sum("n") < LEAST_PAGES).alias("few")).filter("few")
        following = following.join(few, ["host", "template"], "left")
        part = F.when(F.col("few"), "**").when(F.col("literal"), F.col("segment")).otherwise("*")
        ends = F.when(F.col("few"), F.slice("segments", 1, at + 1)).otherwise(F.col("segments"))
        following = following.withColumn("segments", ends)
        following = following.withColumn("template", F.concat("template", F.lit("/"), part))
        level, at = Stored(following.select(*pages.columns), "templates").df, at + 1
        placed = placed.unionByName(level.filter(F.size("segments") == at))
    return placed.drop("segments")


def _smoothed(good: Column, labelled: Column, overall: Column) -> Column:
    return (good + WEIGHT * overall) / (labelled + WEIGHT)


def _merged(templates: DataFrame, depth: int) -> DataFrame:
    """Each template with the branch it belongs to once similar siblings are merged."""
    templates = templates.withColumn("branch", F.lit("")).withColumn("parts", F.split(F.substring("template", 2, 1 << 30), "/"))
    stored = None
    for d in range(depth):
        part = F.when(F.col("template") != "", F.try_element_at("parts", F.lit(d + 1)))
        templates = templates.withColumn("part", part)
        siblings = (
            templates.filter("part IS NOT NULL")
            .groupBy("host", "branch", "part", "overall")
            .agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))
            .withColumn("purity", _smoothed(F.col("g"), F.col("l"), F.col("overall")))
        )
        # Siblings of equal counts are one class, so a window has far fewer rows than a parent
        # has children: n labels make about n ** (2 / 3) different counts at most.
        counts = ["host", "branch", "l", "g"]
        classes = siblings.groupBy(*counts, "purity").agg(F.min("part").alias("part"))
        family = Window.partitionBy("host", "branch").orderBy(F.col("l") == 0, "purity", "part")
        before = {c: F.lag(c).over(family) for c in ("l", "g")}
        here, left = F.nullif(F.col("l"), F.lit(0)), F.nullif(before["l"], F.lit(0))
        pooled = (F.col("g") + before["g"]) / (here + left)
        error = F.sqrt(pooled * (1 - pooled) * (1 / here + 1 / left))
        gap = F.abs(F.col("g") / here - before["g"] / left)
        # Branches without labels come last and are one: nothing tells them apart.
        first_bare = ((F.col("l") == 0) & (before["l"] > 0)).cast("int")
        classes = classes.withColumn("apart", F.coalesce((gap > APART * error).cast("int"), first_bare, F.lit(0)))
        running = family.rowsBetween(Window.unboundedPreceding, 0)
        classes = classes.withColumn("group", F.sum("apart").over(running))
        named = F.min("part").over(Window.partitionBy("host", "branch", "group"))
        classes = classes.withColumn("name", named).select(*counts, "name")
        siblings = siblings.join(classes, counts).select("host", "branch", "part", "name")
        templates = (
            templates.join(siblings, ["host", "branch", "part"], "left")
            .withColumn("branch", F.when(F.col("part").isNull(), F.col("branch")).otherwise(F.concat("branch", F.lit("/"), "name")))
            .drop("part", "name")
        )
        # Each level reads the one before several times, so a plan of many would not end.
        before, stored = stored, Stored(templates, "template-levels")
        templates = stored.df
        if before is not None:
            before.drop()
    return templates.drop("parts")


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], least_purity: float = LEAST_PURITY
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, branch, purity`` for every page.

    ``labels`` has doc_id (the page's id) and quality, 1 for good; null qualities and
    pages without a label count for nothing, several labels of a page count each. Null urls
    and urls without ``://`` have an empty host and path, fall under no rule and share one
    template. ``template`` shows ``MAX_DEPTH`` levels, ``branch`` and ``purity`` follow the whole
    path. A host without labels has the overall purity; without any label that is 1.
    Repeated pages are pages of their own; other columns of ``pages`` are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.count("quality").alias("labelled"), F.count_if(F.col("quality") == 1).alias("good")
    )
    pages = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .join(known, "page_id", "left")
        .fillna(0, ["labelled", "good"])
    )
    placed = _with_templates(pages)
    counted = Stored(
        placed.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")),
        "template-counts",
    ).df
    whole = counted.agg(
        F.sum("labelled").alias("l"), F.sum("good").alias("g"), F.max(F.size(F.split("template", "/")) - 1).alias("depth")
    ).first()
    overall = whole["g"] / whole["l"] if whole["l"] else 1.0
    merged = Stored(_merged(counted.withColumn("overall", F.lit(overall)), whole["depth"] or 0), "template-branches").df
    purity = merged.groupBy("host", "branch").agg(
        _smoothed(F.sum("good"), F.sum("labelled"), F.first("overall")).alias("purity")
    )
    judged = merged.join(purity, ["host", "branch"]).select("host", "template", "branch", "purity")
    found = F.when(F.col("purity") < least_purity, "block").otherwise("allow")
    upper = F.concat(F.substring_index("template", "/", MAX_DEPTH + 1), F.lit("/**"))
    shown = F.when(F.col("depth") > MAX_DEPTH, upper).otherwise(F.col("template"))
    return placed.join(judged, ["host", "template"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, found).alias("verdict"), shown.alias("template"), "branch", "purity"
    )
