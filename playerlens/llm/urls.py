"""URL filtering by curated rules and by association rules mined from the URLs they label.

A URL's tokens are its scheme, host labels, path segments with digits blurred, query names and
fragment. Where a curated rule fits, its verdict is the page's label. FP-growth mines token
combinations that go with a verdict, with tokens that always occur together as one item; those below
a support or confidence, and those that add tokens to a rule that is at least as sure, are pruned. The
remaining rules judge the other URLs: they are indexed by their rarest item, and a URL looks up the
rules of its tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RULE = "struct<rule:string,verdict:string>"


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path``; both are empty for a null URL or one without ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substr("url", at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(raw, _UPPER, _UPPER.lower()), "path": path})


def curated(rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest fitting rule as ``rule, verdict``, or null. Of equally long ones the first."""
    found = F.lit(None).cast(_RULE)
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits &= F.col("path").startswith(path)
        rule = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, rule).otherwise(found)
    return found


def tokens() -> Column:
    """Sorted distinct tokens of ``url, host, path``; none for a URL without ``://``."""
    url = F.coalesce("url", F.lit(""))
    blurred = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    every = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1))),
        F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.split("path", "/"), lambda x: F.concat(F.lit("path:"), blurred(x))),
        F.transform(
            F.split(query, "&"),
            lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^[^=]*", 0)),
        ),
        F.array(F.concat(F.lit("part:"), F.regexp_extract(url, "#(.*)$", 1))),
    )
    named = F.filter(every, lambda x: ~x.endswith(":"))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(named))).otherwise(
        F.array().cast("array<string>")
    )


def token_groups(labelled: DataFrame, least: float) -> DataFrame:
    """``token, members``: the first of each group of tokens that occur in exactly the same rows.

    Only tokens of at least ``least`` rows: there are at most as many as a row's tokens divided by
    the support. The sets of rows are compared by their number and 128 bits of hash.
    """
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("n"))
    hashes = [F.xxhash64(F.lit(i), "tokens") for i in range(2)]
    spread = sets.select("n", *[h.alias(f"h{i}") for i, h in enumerate(hashes)], F.explode("tokens").alias("token"))
    seen = spread.groupBy("token").agg(
        F.sum("n").alias("rows"), F.count("*").alias("sets"), F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1")
    )
    alike = seen.filter(F.col("rows") >= least).groupBy("rows", "sets", "h0", "h1")
    # All of a group stand in one URL, so a group is no longer than that.
    return alike.agg(F.min("token").alias("token"), F.array_sort(F.collect_list("token")).alias("members"))


def mine(
    labelled: DataFrame, *, min_support: float = 0.01, min_confidence: float = 0.8
) -> DataFrame:
    """``antecedent, verdict, confidence, support`` from rows of ``tokens, verdict``.

    All labelled rows count. A rule is dropped when one with fewer of its tokens and the same
    verdict is at least as confident. Tokens that always occur together are one item, or the tokens
    of a frequent template would have as many frequent sets as they have subsets; a rule with one of
    them holds for each. An antecedent is a list of such groups: a URL needs a token of each.
    """
    groups = token_groups(labelled, min_support * labelled.count())
    items = {r["token"]: r["members"] for r in groups.collect()}
    mark = F.concat(F.lit("verdict="), F.col("verdict"))
    known = F.array_intersect("tokens", F.array(*map(F.lit, items)).cast("array<string>"))
    baskets = labelled.select(F.concat(known, F.array(mark)).alias("items"))
    model = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter(F.get("consequent", F.lit(0)).startswith("verdict="))
    rules = rules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substr(F.get("consequent", F.lit(0)), F.lit(len("verdict=") + 1)).alias("verdict"),
        "confidence",
        "support",
    )
    less = rules.select(
        F.explode("antecedent").alias("token"),
        F.col("antecedent").alias("less"),
        F.col("verdict").alias("same"),
        F.col("confidence").alias("sure"),
    )
    # A shorter rule shares its first token with every rule it makes redundant.
    less = less.filter(F.col("token") == F.get("less", F.lit(0)))
    more = rules.select("*", F.explode("antecedent").alias("token"))
    redundant = more.join(less, "token").filter(
        (F.col("same") == F.col("verdict"))
        & (F.size("less") < F.size("antecedent"))
        & (F.size(F.array_except("less", "antecedent")) == 0)
        & (F.col("sure") >= F.col("confidence"))
    )
    gone = redundant.select("antecedent", "verdict").distinct()
    left = rules.join(gone, ["antecedent", "verdict"], "left_anti")
    named = left.select("*", F.posexplode("antecedent").alias("_at", "token")).join(groups, "token")
    whole = named.groupBy("antecedent", "verdict", "confidence", "support").agg(
        F.array_sort(F.collect_list(F.struct("_at", "members"))).alias("_groups")
    )
    return whole.withColumn("antecedent", F.col("_groups.members")).drop("_groups")


def judge(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """``tokens, verdict`` for the token sets (one row each) that some rule matches.

    The surest rule decides, then the one with more support, then text order of the tokens by which
    the rule fits. A rule is indexed by the tokens of its rarest group.
    """
    spread = sets.select("tokens", F.explode("tokens").alias("token"))
    common = spread.groupBy("token").agg(F.count("*").alias("n"))
    by_group = rules.select("*", F.explode("antecedent").alias("group"))
    by_token = by_group.select("*", F.explode("group").alias("token")).join(common, "token")
    name = ["antecedent", "verdict", "confidence", "support"]
    sizes = by_token.groupBy(*name, "group").agg(F.sum("n").alias("n"))
    index = sizes.groupBy(*name).agg(F.min(F.struct("n", "group")).alias("rarest"))
    index = index.select(*name, F.explode("rarest.group").alias("token"))
    own = lambda group: F.array_intersect(group, "tokens")
    hits = spread.join(index, "token").filter(F.forall("antecedent", lambda g: F.size(own(g)) > 0))
    fits = F.array_sort(F.transform("antecedent", lambda g: F.array_max(own(g)))).alias("fits")
    best = F.max(F.struct("confidence", "support", fits, "verdict")).alias("best")
    return hits.groupBy("tokens").agg(best).select("tokens", F.col("best.verdict").alias("verdict"))


def filter_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    *,
    min_support: float = 0.01,
    min_confidence: float = 0.8,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, mined``; ``rule`` is null where none fits.

    ``mined`` says that an association rule gave the verdict. Without one (also when nothing could
    be mined) it is ``default``. Columns of the new names are replaced.
    """
    base = with_parts(pages.drop("host", "path", "rule", "verdict", "mined"))
    base = base.withColumn("_rule", curated(rules)).withColumn("_tokens", tokens())
    counted = base.select(F.col("_tokens").alias("tokens"), F.col("_rule.verdict").alias("verdict"))
    found = mine(
        counted.filter("verdict IS NOT NULL"),
        min_support=min_support,
        min_confidence=min_confidence,
    )
    sets = counted.filter("verdict IS NULL AND size(tokens) > 0").select("tokens").distinct()
    judged = judge(found, sets).select(F.col("tokens").alias("_set"), F.col("verdict").alias("_judged"))
    open_ = F.col("_rule").isNull()
    out = base.join(judged, open_ & (F.col("_tokens") == F.col("_set")), "left")
    return out.select(
        *pages.drop("host", "path", "rule", "verdict", "mined").columns,
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_judged", F.lit(default)).alias("verdict"),
        F.coalesce(open_ & F.col("_judged").isNotNull(), F.lit(False)).alias("mined"),
    )
