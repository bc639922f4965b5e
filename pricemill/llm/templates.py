"""URL filter by rules and, where no rule fits, by a tree of path templates per host. DataFrame operations only.

URLs that a rule judges are the labelled examples of their host. A path is a walk down its host's tree. Level by
level, runs of digits are generalised, a segment that few of its siblings' URLs share is a value and becomes the
wildcard, and so does a branch that does not differ from the rest of its siblings, neither in the shapes of what
follows nor in the share of blocked examples. What remains are templates. A template is rejected if the smoothed
share of blocked ones among its examples is high; one with few or no examples is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import stored

#: (verdict, host and start of the path); the longest rule that fits decides.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

#: Levels of the tree; deeper segments are one wildcard.
DEPTH = 8
#: A segment keeps its name only if at least one in so many URLs below its parent has it.
NAMED = 64
#: Classes of what follows a segment, by a hash of its shape.
SHAPES = 16
#: Branches differ if a chi-squared test says so at one in a thousand (a normal quantile) and the distance is above this.
APART = 0.1
NORMAL = 3.09
#: A template is rejected from this smoothed share of blocked examples on (in per cent); one blocked and one allowed
#: example are added to each template.
REJECT = 80

#: A path's end, the segments beyond the last level, and the wildcard; in segments `$` and `*` are spelled %24 and %2A.
END, BEYOND, ANY = "$", "**", "*"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as the url spells them, but with the host's A-Z in lower case; both empty without `://`."""
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, _URL, 1), _UPPER, _LOWER), F.regexp_extract(whole, _URL, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, of equally long ones the one with the longer host."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].find("/"), r[1])):
        of, start = rule.split("/", 1)
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The path's segments with runs of digits as `#`, at most DEPTH of them, and its end."""
    plain = F.replace(F.replace(F.regexp_replace(path, "^/", ""), F.lit("$"), F.lit("%24")), F.lit("*"), F.lit("%2A"))
    segments = F.split(F.regexp_replace(plain, "[0-9]+", "#"), "/", -1)
    empty = F.array(F.lit(END))
    deep = F.concat(F.slice(segments, 1, DEPTH), F.array(F.lit(BEYOND)))
    return F.when(path.isin("", "/"), empty).when(F.size(segments) > DEPTH, deep).otherwise(F.concat(segments, empty))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)


def _differs(own: Column, rest: Column) -> Column:
    """Whether two arrays of counts differ: by their total variation distance, and in a chi-squared test for as many
    classes as occur (quantile by Wilson and Hilferty)."""
    a, b = _total(own), _total(rest)
    distance = _total(F.zip_with(own, rest, lambda x, y: F.abs(x / a - y / b))) / 2
    parts = F.zip_with(own, rest, lambda x, y: F.when(x + y > 0, (x * b - y * a) * (x * b - y * a) / (x + y)).otherwise(0.0))
    chi = _total(parts) / (a * b)
    df = F.greatest(F.size(F.filter(F.zip_with(own, rest, lambda x, y: x + y), lambda n: n > 0)) - 1, F.lit(1)).cast("double")
    root = 1 - 2 / (9 * df) + NORMAL * F.sqrt(2 / (9 * df))
    return F.when((a > 0) & (b > 0), (distance > APART) & (chi > df * root * root * root)).otherwise(False)


def _level(walks: DataFrame, level: int) -> DataFrame:
    """Walks with the template one segment longer."""
    child = F.get("shape", F.lit(level))
    after = F.transform(F.slice("shape", level + 2, DEPTH + 2), lambda x: F.regexp_replace(x, "[^#$*]+", "w"))
    follows = F.conv(F.substring(F.md5(F.concat_ws(" ", after)), 1, 1), 16, 10).cast("int")
    here = walks.withColumns({"child": child, "follows": follows})
    shapes = [F.sum(F.when(F.col("follows") == k, F.col("n")).otherwise(0)).cast("double") for k in range(SHAPES)]
    labels = [F.sum(c).cast("double") for c in ("bad", "good")]
    branches = here.where(~F.col("child").isin(END, BEYOND)).groupBy("host", "template", "child")
    children = stored(branches.agg(F.sum("n").alias("n"), F.array(*shapes).alias("shapes"), F.array(*labels).alias("labels")))
    both = {"all_shapes": ("shapes", SHAPES), "all_labels": ("labels", 2)}
    sums = [F.array(*[F.sum(F.get(c, F.lit(k))) for k in range(size)]).alias(name) for name, (c, size) in both.items()]
    parents = stored(children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("all"), *sums))
    rest = {c: F.zip_with(f"all_{c}", c, lambda x, y: x - y) for c in ("shapes", "labels")}
    apart = _differs(F.col("shapes"), rest["shapes"]) | _differs(F.col("labels"), rest["labels"])
    named = (F.col("children") == 1) | ((F.col("n") * NAMED >= F.col("all")) & apart)
    # A parent has few named children, since each holds a part of its URLs.
    names = stored(children.join(parents, ["host", "template"]).where(named).select("host", "template", "child", F.lit(True).alias("named")))
    step = F.when(F.col("child").isin(END, BEYOND) | F.col("named"), F.col("child")).otherwise(F.lit(ANY))
    longer = F.when(F.col("child").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), step))
    joined = here.join(names, ["host", "template", "child"], "left")
    return stored(joined.select("host", "shape", "n", "bad", "good", longer.alias("template")))


def templates_of(urls: DataFrame) -> DataFrame:
    """(host, shape, template) of every shape of urls (host, shape, verdict), where verdict is that of a rule or null."""
    walks = stored(
        urls.groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.sum((F.col("verdict") == "block").cast("long")).alias("bad"), F.sum((F.col("verdict") == "allow").cast("long")).alias("good")
        ).select("host", "shape", "n", F.coalesce("bad", F.lit(0)).alias("bad"), F.coalesce("good", F.lit(0)).alias("good"), F.lit("").alias("template"))
    )
    deepest = walks.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(deepest):
        walks = _level(walks, level)
    return walks


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked, allowed) for every row: the verdict of the longest rule
    that fits, or else of the url's template; blocked and allowed are the template's examples.

    A null url, one without `://` and an empty one have an empty host and path; these are judged as any other. Long
    urls are read whole; segments beyond the eighth are one wildcard of the tree. Repeated rows are examples and are
    answered each on their own; ids are only passed through, null or not. Rules are a list held in the plan, of some
    hundreds at most; without rules everything is allowed. Other columns are not looked at, whatever their names. An
    empty table gives no rows.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = parsed.withColumn("of", fitting_rule(F.col("host"), F.col("path"), rules))
    urls = stored(ruled.select("page_id", "host", "path", "of.rule", "of.verdict", shape_of(F.col("path")).alias("shape")))
    walks = templates_of(urls)
    judged = stored(walks.groupBy("host", "template").agg(F.sum("bad").alias("blocked"), F.sum("good").alias("allowed")))
    known = stored(walks.select("host", "shape", "template").join(judged, ["host", "template"]))
    rejected = 100 * (F.col("blocked") + 1) >= REJECT * (F.col("blocked") + F.col("allowed") + 2)
    own = F.when(rejected, "block").otherwise("allow")
    return urls.join(known, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "template", "blocked", "allowed"
    )
