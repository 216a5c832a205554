"""Pattern matches with their places in a text, by SQL functions alone.

Places are code points, end exclusive. A match is fenced by U+0001 (a U+0001 of the text itself is
first turned into U+0002; neither occurs in a pattern), the text is split at the fences, and running
lengths of the pieces give the places. All matches of a text come out of one replacing pass.

Patterns must not loop over groups without a bound: Java's matcher recurses there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE, _OTHER = "\x01", "\x02"
CONTEXT = 24
MATCH = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def matches(text: Column, pattern: str) -> Column:
    """``MATCH`` array of the leftmost, non-overlapping matches; empty for null."""
    clean = F.translate(text, _FENCE, _OTHER)
    pieces = F.split(F.regexp_replace(clean, pattern, f"{_FENCE}$0{_FENCE}"), _FENCE)
    return F.when(text.rlike(pattern), _placed(pieces)).otherwise(F.array().cast(MATCH))


def _placed(pieces: Column) -> Column:
    ends = F.aggregate(
        pieces,
        F.array(F.lit(0).cast("long")),
        lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + F.char_length(x))),
    )
    # One lambda variable holds pieces and ends, so that neither is computed for every match.
    held = F.array(F.struct(pieces.alias("p"), ends.alias("e")))
    placed = F.transform(
        held,
        lambda h: F.filter(
            F.transform(
                h["p"],
                lambda x, i: F.when(
                    i % 2 == 1,
                    F.struct(
                        F.get(h["e"], i).alias("start"),
                        F.get(h["e"], i + 1).alias("end"),
                        x.alias("value"),
                        F.right(F.get(h["p"], i - 1), F.lit(CONTEXT)).alias("before"),
                        F.left(F.get(h["p"], i + 1), F.lit(CONTEXT)).alias("after"),
                    ),
                ),
            ),
            lambda m: m.isNotNull(),
        ),
    )
    return F.get(placed, F.lit(0)).cast(MATCH)


def replaced(text: Column, pattern: str, good, by: str) -> Column:
    """``text`` with the matches for which ``good(value)`` holds replaced."""
    clean = F.translate(text, _FENCE, _OTHER)
    pieces = F.split(F.regexp_replace(clean, pattern, f"{_FENCE}$0{_FENCE}"), _FENCE)
    new = F.transform(pieces, lambda x, i: F.when((i % 2 == 1) & good(x), F.lit(by)).otherwise(x))
    return F.when(text.rlike(pattern), F.array_join(new, "")).otherwise(text)


def labelled(found: Column, rank: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(F.lit(rank).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    )


def overlaps(match: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < match["end"]) & (match["start"] < b["end"]))


def listed(spans: Column, names: tuple[str, ...], by_kind: bool) -> Column:
    """``kind:start:end`` of each span, comma-joined, sorted by kind and start or start and kind."""
    keys = ("kind", "start") if by_kind else ("start", "kind")
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s[keys[0]].alias(keys[0]), s[keys[1]].alias(keys[1]), s["end"].alias("end")))
    )
    kinds = F.array(*map(F.lit, names))
    shown = F.transform(
        ordered, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
    )
    return F.array_join(shown, ",")


def masked(text: Column, spans: Column, names: tuple[str, ...]) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans are joined."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    kind = "array<struct<start:bigint,end:bigint,kind:int>>"

    def joined(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.array(
            F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        )
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"]),
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), longer),
        ).otherwise(F.concat(done, F.array(s)))

    runs = F.aggregate(ordered, F.array().cast(kind), lambda d, s: joined(d, s).cast(kind))
    held = F.array(runs)
    marks = F.array(*(F.lit(f"[{n}]") for n in names))
    built = F.transform(
        held,
        lambda r: F.concat(
            F.array_join(
                F.transform(
                    r,
                    lambda s, i: F.concat(
                        F.substr(
                            text,
                            (start := F.when(i > 0, F.get(r, i - 1)["end"]).otherwise(F.lit(0))).cast("int") + 1,
                            (s["start"] - start).cast("int"),
                        ),
                        F.get(marks, s["kind"]),
                    ),
                ),
                "",
            ),
            F.substr(text, F.coalesce(F.try_element_at(r, F.lit(-1))["end"], F.lit(0)).cast("int") + 1),
        ),
    )
    return F.when(F.size(spans) > 0, F.get(built, F.lit(0))).otherwise(text)
