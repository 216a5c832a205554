"""Personal data by candidate generation and boosted trees.

Four base formats (mail address, IP address, card number, telephone number) always count. Two
high-recall generators propose further, overlapping spans: number-like runs, and addresses that may
be written with ``(at)`` and ``[dot]``. Gradient-boosted trees score a candidate by its format and
the text around it; candidates above a calibrated threshold are added.

The trees are trained here. Labels are weak: a candidate that coincides with a valid base match is
personal data; one apart from all base matches is none if its context or its form speaks against it,
and has no label otherwise. What makes a match a base match is hidden from the trees, or they could
only find those again. They learn from all candidates, counted by their features, and become one SQL
expression, so that scoring needs neither a join nor another pass over the texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlens.llm.spans import labelled, listed, masked, matches, overlaps
from playerlens.session import cut_lineage

KINDS = ("email", "ip", "card", "phone", "other")
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
# The base formats, written so that Java's matcher neither backtracks over long runs nor recurses
# without a bound. A run of address characters is entered at its start or after the match before.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?>(?>(?>\.{_LABEL}++){{1,64}}){{1,64}})+"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What may be personal data: numbers with separators, addresses in disguise.
NUMBER = r"[+(]?[0-9][0-9\x20().,/:-]{5,}[0-9]"
ADDRESS = (
    rf"(?<!{_LOCAL}){_LOCAL}{{2,64}}+\x20?(?:@|[\[({{]\x20?at\x20?[\])}}])\x20?{_LABEL}{{1,63}}+"
    rf"\x20?(?:\.|[\[({{]\x20?dot\x20?[\])}}])\x20?[A-Za-z]{{2,24}}"
    rf"(?>(?:\.|\x20?[\[({{]\x20?dot\x20?[\])}}]\x20?){_LABEL}{{1,63}}+){{0,8}}+"
)
_CUES = (
    r"(?i)(phone|tel|call|mobile|fax|cell)",
    r"(?i)(card|visa|credit|account|iban|pay)",
    r"(?i)(mail|contact|write|address)",
    r"(?i)(\bip\b|host|server|addr)",
    r"(?i)(order|invoice|version|page|isbn|no\.|#)\W*$",
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    """Whether all dot-separated numbers are at most 255."""
    bare = lambda x: F.regexp_replace(x, "^0+", "")
    return F.forall(
        F.split(value, r"\."),
        lambda x: (F.length(bare(x)) < 3) | ((F.length(bare(x)) == 3) & (bare(x) <= "255")),
    )


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(_digits(value)), "")
    worth = F.transform(
        digits,
        lambda x, i: F.when(x == "", 0)
        .when(i % 2 == 0, F.ascii(x) - 48)
        .otherwise((F.ascii(x) - 48) * 2 - F.when(x >= "5", 9).otherwise(0)),
    )
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def _count(value: Column, characters: str) -> Column:
    return F.length(value) - F.length(F.translate(value, characters, ""))


def features(m: Column) -> Column:
    """Context and open form of a candidate as numbers.

    What tells the base formats apart (signs, separators, exact counts, checksums) is left out.
    """
    value, before, after = m["value"], m["before"], m["after"]
    numbers = [
        F.length(_digits(value)).between(7, 19),
        value.rlike("[A-Za-z]"),
        _count(value, ",/:"),
        before.rlike(r"[A-Za-z0-9]$"),
        after.rlike(r"^[A-Za-z0-9%]"),
        before.rlike("[0-9]"),
        after.rlike("[0-9]"),
        *(before.rlike(cue) for cue in _CUES),
    ]
    return F.array(*(F.coalesce(x.cast("double"), F.lit(0.0)) for x in numbers))


# Places in ``features`` that the weak labels look at.
_SOME_DIGITS, _LETTERS, _OTHER_MARKS = 0, 1, 2
_FOR, _AGAINST = range(7, 11), 11


def _label(c: Column, base: Column) -> Column:
    """1 for a base match, 0 for what context or form speak against, null for the undecided.

    Numbers are spoken against by a cue against them, by no cue for them, by fewer than seven or more
    than 19 digits and by marks no base format has; addresses by a cue against them only.
    """
    f = c["f"]
    same = F.exists(base, lambda b: (b["start"] == c["start"]) & (b["end"] == c["end"]))
    cue = F.exists(F.array(*(F.get(f, F.lit(i)) for i in _FOR)), lambda x: x > 0)
    number = F.get(f, F.lit(_LETTERS)) == 0
    odd = (F.get(f, F.lit(_SOME_DIGITS)) == 0) | (F.get(f, F.lit(_OTHER_MARKS)) > 0)
    against = (F.get(f, F.lit(_AGAINST)) > 0) | (number & (~cue | odd))
    return F.when(same, 1.0).when(~overlaps(c, base) & against, 0.0)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``email, ip, card, phone`` (valid base matches) and ``candidates``.

    A candidate is ``start, end, f``: its place and its features.
    """
    text = F.col("text")
    found = docs.withColumns(
        {
            "email": matches(text, EMAIL),
            "ip": F.filter(matches(text, IP), lambda m: _small_parts(m["value"])),
            "card": F.filter(matches(text, CARD), lambda m: _luhn(m["value"])),
            "phone": F.filter(
                matches(text, PHONE), lambda m: F.length(_digits(m["value"])).between(9, 15)
            ),
            "candidates": F.concat(matches(text, NUMBER), matches(text, ADDRESS)),
        }
    )
    placed = F.transform(
        "candidates",
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), features(m).alias("f")),
    )
    return found.withColumn("candidates", placed)


def _base() -> Column:
    return F.concat(*(labelled(F.col(k), i) for i, k in enumerate(KINDS[:4])))


@dataclass
class Trees:
    """Boosted trees as text, their weights, and the probability from which a candidate counts."""

    trees: list[str]
    weights: list[float]
    threshold: float

    def probability(self, f: Column) -> Column:
        total = sum(
            (w * _as_column(t, f) for t, w in zip(self.trees, self.weights, strict=True)), F.lit(0.0)
        )
        return 1 / (1 + F.exp(-2 * total))


_LINE = re.compile(r"^ *(If|Else|Predict)[ :]*(?:\(feature (\d+) (<=|>) ([-0-9.E]+)\)|([-0-9.E]+))$")


def _as_column(tree: str, f: Column) -> Column:
    lines = [m.groups() for m in map(_LINE.match, tree.splitlines()) if m]
    at = iter(lines)

    def node() -> Column:
        what, feature, _, limit, value = next(at)
        if what == "Predict":
            return F.lit(float(value))
        low = node()
        next(at)  # the Else of the same question
        return F.when(F.get(f, F.lit(int(feature))) <= float(limit), low).otherwise(node())

    return node()


def learn(
    found: DataFrame,
    *,
    precision: float = 0.98,
    trees: int = 12,
    depth: int = 4,
    seed: int = 1,
) -> Trees | None:
    """Trees from all labelled candidates of ``scan``.

    Candidates of equal features and label are one row with their number as its weight, so the trees
    pass over the different ones only. Four fifths, chosen by a hash of the candidate, train; on the rest the threshold is
    set to the least probability from which on labels agree at ``precision``. None when there is only
    one label.
    """
    rows = found.select(F.explode("candidates").alias("c"), _base().alias("b")).select(
        F.col("c.f").alias("f"),
        _label(F.col("c"), F.col("b")).alias("label"),
        F.pmod(F.xxhash64(F.lit("fold"), "c"), F.lit(5)).alias("fold"),
    )
    counted = rows.filter("label IS NOT NULL").groupBy("f", "label", (F.col("fold") == 4).alias("held_out")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Stored once, in an order that no partition changes: the trees pass over it many times.
    counted = cut_lineage(counted.orderBy("f", "label", "held_out"))
    counted = counted.withColumns({"features": array_to_vector("f"), "weight": F.col("n").cast("double")})
    train = counted.filter("NOT held_out")
    per_label = train.groupBy("label").agg(F.sum("weight").alias("weight")).collect()
    if len(per_label) < 2:
        return None
    whole = sum(r["weight"] for r in per_label)
    model = GBTClassifier(
        maxIter=trees,
        maxDepth=depth,
        seed=seed,
        weightCol="weight",
        minInstancesPerNode=1,
        minWeightFractionPerNode=min(5 / whole, 0.49),  # five candidates
        cacheNodeIds=False,
    ).fit(train)
    shapes = [t.toDebugString.partition("\n")[2] for t in model.trees]  # without their ids
    made = Trees(shapes, list(model.treeWeights), 1.0)
    scored = counted.filter("held_out").select(
        F.round(made.probability(F.col("f")), 2).alias("p"), "label", "n"
    )
    by = scored.groupBy("p").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good"))
    n = good = 0
    for row in sorted(by.collect(), reverse=True):  # at most 101 rows
        n, good = n + row["n"], good + row["good"]
        if good < precision * n:
            break
        made.threshold = row["p"]
    return made


def _added(model: Trees | None) -> Column:
    if model is None:
        return F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    sure = F.filter(
        "candidates",
        lambda c: ~overlaps(c, F.col("_base")) & (model.probability(c["f"]) >= model.threshold),
    )
    return F.array_distinct(labelled(sure, 4))


def personal_data(found: DataFrame, model: Trees | None) -> DataFrame:
    """Rows of ``scan`` with ``n_email, n_ip, n_card, n_phone, n_other, base_sha256, spans``.

    A null or empty text has no spans. Candidates that overlap a base match add nothing.
    """
    out = found.withColumn("_base", _base())
    out = out.withColumn("_added", _added(model))
    return out.select(
        *(c for c in found.columns if c not in (*KINDS, "candidates")),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.size("_added").cast("long").alias("n_other"),
        F.sha2(listed(F.col("_base"), KINDS, True).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("_base", "_added"), KINDS, True).alias("spans"),
    )


def redact(docs: DataFrame, model: Trees | None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind in brackets."""
    found = scan(docs.withColumns({f"_{c}": F.col(c) for c in docs.columns}))
    found = found.withColumn("_base", _base()).withColumn("_added", _added(model))
    text = masked(F.col("_text"), F.concat("_base", "_added"), KINDS)
    kept = [text.alias("text") if c == "text" else F.col(f"_{c}").alias(c) for c in docs.columns]
    return found.select(*kept)
