"""Secret scanning: fixed formats, and character Markov models for strings without one.

Two first-order models over characters are kept, one of random strings and one of ordinary words
and identifiers. A candidate string is reported when the logarithm of its likelihood ratio under
the two is large. Both are trained here: random strings are labelled by the fixed formats (the
secret parts of all their matches), ordinary ones are the words of a bounded sample of texts in
which no format matches. Everything is SQL functions; the models are one array of 128 x 128 ratios.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlens.llm.spans import MATCH, labelled, listed, matches, overlaps, replaced
from playerlens.llm.text import sample_of

KINDS = ("assign", "access", "hex", "random")
# The formats, in the order in which they are listed.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Candidates: whole runs of the characters of keys that hold a digit and a letter.
_RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z]){_RUN}{{16,}}+"
_WORD = r"[A-Za-z0-9+/_=-]{4,}"
_SIDE = 128


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 1)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the arrays ``assign, access, hex`` of format matches and ``candidates``."""
    assign = F.filter(matches(F.col("text"), ASSIGN), lambda m: F.length(_assigned(m["value"])) >= 6)
    return docs.withColumns(
        {
            "assign": assign,
            "access": matches(F.col("text"), ACCESS),
            "hex": matches(F.col("text"), HEX),
            "candidates": matches(F.col("text"), CANDIDATE),
        }
    )


def _pairs(strings: DataFrame) -> DataFrame:
    """How often each character follows each other one in the column ``s``."""
    codes = F.transform(F.split("s", ""), F.ascii)
    held = F.array(codes)
    pairs = F.transform(
        held,
        lambda c: F.transform(
            F.sequence(F.lit(0), F.size(c) - 2), lambda i: F.get(c, i) * _SIDE + F.get(c, i + 1)
        ),
    )
    return (
        strings.filter(F.length("s") >= 2)
        .select(F.explode(F.get(pairs, F.lit(0))).alias("pair"))
        .groupBy("pair")
        .count()
    )


def _log_model(counts: dict[int, int], smoothing: float) -> list[float]:
    """Log transition probabilities, each row smoothed towards how often characters occur at all."""
    total = sum(counts.values())
    seen = [sum(counts.get(a * _SIDE + b, 0) for a in range(_SIDE)) for b in range(_SIDE)]
    alone = [(n + 0.5) / (total + 0.5 * _SIDE) for n in seen]
    out = []
    for a in range(_SIDE):
        row = [counts.get(a * _SIDE + b, 0) for b in range(_SIDE)]
        out += [
            math.log((n + smoothing * p) / (sum(row) + smoothing))
            for n, p in zip(row, alone, strict=True)
        ]
    return out


def learn(
    found: DataFrame, docs: DataFrame, *, sample_rows: int = 2000, smoothing: float = 16.0
) -> str | None:
    """The log ratios as a JSON array; None when there is nothing to learn from on either side.

    ``found`` comes from ``scan``: all its format matches are used. The ordinary words come from at
    most ``sample_rows`` texts, chosen by hash; strings that are candidates themselves have no label.
    """
    secret = F.concat(
        F.transform("assign", lambda m: _assigned(m["value"])),
        F.transform("access", lambda m: F.substr(m["value"], F.lit(5))),
        F.transform("hex", lambda m: m["value"]),
    )
    random = {r[0]: r[1] for r in _pairs(found.select(F.explode(secret).alias("s"))).collect()}
    plain = sample_of(docs.select("text").filter("text IS NOT NULL"), "text", sample_rows).filter(
        ~(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX))
    )
    words = plain.select(F.explode(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).alias("s"))
    words = words.filter(~F.col("s").rlike(CANDIDATE))
    ordinary = {r[0]: r[1] for r in _pairs(words).collect()}
    if not random or not ordinary:
        return None
    ratio = zip(_log_model(random, smoothing), _log_model(ordinary, smoothing), strict=True)
    return json.dumps([round(a - b, 4) for a, b in ratio])


def log_ratio(value: Column, model: str) -> Column:
    table = F.from_json(F.lit(model), "array<double>")
    held = F.array(F.transform(F.split(value, ""), F.ascii))
    return F.get(
        F.transform(
            held,
            lambda c: F.aggregate(
                F.sequence(F.lit(0), F.size(c) - 2),
                F.lit(0.0),
                lambda total, i: total + F.get(table, F.get(c, i) * _SIDE + F.get(c, i + 1)),
            ),
        ),
        F.lit(0),
    )


def secrets(found: DataFrame, model: str | None, *, min_log_ratio: float = 12.0) -> DataFrame:
    """The rows of ``scan`` with ``n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    Format matches always count. A candidate that overlaps none of them counts as ``random`` from
    ``min_log_ratio`` nats on. A null or empty text has no spans; the digest is that of the empty
    text then.
    """
    base = F.concat(*(labelled(F.col(k), i) for i, k in enumerate(KINDS[:3])))
    out = found.withColumn("_base", base)
    added = F.array().cast(MATCH)
    if model is not None:
        added = F.filter(
            "candidates",
            lambda m: ~overlaps(m, F.col("_base")) & (log_ratio(m["value"], model) >= min_log_ratio),
        )
    out = out.withColumn("_added", labelled(added, 3))
    return out.select(
        *(c for c in found.columns if c not in (*KINDS, "candidates")),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.size("_added").cast("long").alias("n_random"),
        F.sha2(listed(F.col("_base"), KINDS, False).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("_base", "_added"), KINDS, False).alias("spans"),
    )


def redact(
    docs: DataFrame, model: str | None, *, by: str = "[redacted]", min_log_ratio: float = 12.0
) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced; other texts stay as they are."""
    text = replaced(F.col("text"), ASSIGN, lambda x: F.length(_assigned(x)) >= 6, by)
    out = docs.withColumn("text", text)
    for pattern in (ACCESS, HEX):
        out = out.withColumn("text", F.regexp_replace("text", pattern, by.replace("$", r"\$")))
    if model is None:
        return out
    random = replaced(
        F.col("text"), CANDIDATE, lambda x: log_ratio(x, model) >= min_log_ratio, by
    )
    return out.withColumn("text", random)
