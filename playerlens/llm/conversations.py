"""Repair of turn structure by weighted CYK parsing over spans of a conversation.

A grammar of role sequences is given as an automaton. In Chomsky normal form its nonterminals are
pairs of states, ``[p, q] -> [p, k] [k, q]``, and a row derives ``[p, q]`` by an edit: keep, rerole or
delete. Inserted rows derive ``[p, q]`` from nothing; their closure is put around every row. A span's
table has for each nonterminal the cheapest derivation with its audit, one letter an edit, and is
filled bottom-up: rows, then spans twice as long, and so on. In such a grammar every way to cut a
span in two derives the same nonterminals at the same cost, so one cut is enough.

Two audits of one span at one cost are never prefixes of each other (what is longer has more
inserted rows, which cost), so the least audit of a whole is made of the least audits of its parts.

A conversation may hold any share of all rows: rows are range-sorted by conversation and turn, each
sorted partition parses its own span, and the spans of a conversation are combined some at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from playerlens.session import cut_lineage

SPACE = " \t\n\v\f\r"
#: Edits' initials.
KEEP, REROLE, DELETE, INSERT = "KRDI"
#: Kinds of rows that are not initials of the grammar.
OTHER, CUT_OTHER, GONE = "?", "!", "-"
FAN_IN = 16
_BLOCK = 8
_POSITION_BITS = 33  # monotonically_increasing_id() keeps the partition above this bit

Cell = tuple[int, str, str]  # cost, audit, initials of the rows that remain
Table = dict[tuple[int, int], Cell]


@dataclass(frozen=True)
class Grammar:
    """Role sequences by the roles' initials, and what edits cost.

    ``steps`` maps (state, initial) to the next state; ``roles`` names the roles that may be written.
    The start has to accept, so that a conversation can always be repaired by deleting its rows.
    """

    steps: tuple[tuple[int, str, int], ...]
    accepting: tuple[int, ...]
    roles: tuple[tuple[str, str], ...]
    start: int = 0
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1
    initials: frozenset[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "initials", frozenset(c for _, c, _ in self.steps))
        if not all(len(c) == 1 and c.isascii() and c.islower() for c in self.initials):
            raise ValueError("initials are lower-case letters")

    def states(self) -> set[int]:
        return {self.start, *(p for p, _, _ in self.steps), *(q for _, _, q in self.steps)}

    def neighbours(self) -> set[str]:
        """Pairs of initials that may follow each other."""
        return {a + b for _, a, q in self.steps for p, b, _ in self.steps if p == q}

    def row(self, kind: str) -> list[tuple[int, int, Cell]]:
        """Edits of one row. ``kind`` is its initial, in upper case when its text is truncated; ``?``
        and ``!`` stand for initials that are not in the grammar, ``-`` for a row that has to go."""
        out = [(p, p, (self.delete, DELETE, "")) for p in self.states()]
        if kind == GONE:
            return out
        extra = self.truncated if kind.isupper() or kind == CUT_OTHER else 0
        for p, c, q in self.steps:
            if c == kind.lower():
                out.append((p, q, (extra, KEEP, c)))
            if c in dict(self.roles):
                out.append((p, q, (self.rerole + extra, REROLE, c)))
        return out


#: An optional system row, then user and assistant in turn, or nothing.
DIALOGUE = Grammar(
    steps=((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)),
    accepting=(0, 3),
    roles=(("u", "user"), ("a", "assistant")),
)


def _put(table: Table, key: tuple[int, int], cell: Cell) -> None:
    if key not in table or cell < table[key]:
        table[key] = cell


def combined(left: Table, right: Table) -> Table:
    """The table of two neighbouring spans: ``[p, q] -> [p, k] [k, q]``."""
    out: Table = {}
    after: dict[int, list] = {}
    for (k, q), cell in right.items():
        after.setdefault(k, []).append((q, cell))
    for (p, k), (cost, audit, roles) in left.items():
        for q, (c, a, r) in after.get(k, ()):
            known = out.get((p, q))
            if known is None or cost + c <= known[0]:
                _put(out, (p, q), (cost + c, audit + a, roles + r))
    return out


class Parser:
    """Tables of spans of rows, given as strings of kinds (see ``Grammar.row``)."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        closure: Table = {(p, p): (0, "", "") for p in grammar.states()}
        step: Table = {}
        for p, c, q in grammar.steps:
            if c in dict(grammar.roles):
                _put(step, (p, q), (grammar.insert, INSERT, c))
        while True:
            longer = dict(closure)
            for key, cell in combined(closure, step).items():
                _put(longer, key, cell)
            if longer == closure:
                break
            closure = longer
        self.closure = closure
        self.short = lru_cache(maxsize=1 << 16)(self._short)

    def _short(self, kinds: str) -> Table:
        if len(kinds) > 1:
            half = (len(kinds) + 1) // 2
            return combined(self.short(kinds[:half]), self.short(kinds[half:]))
        edits: Table = {}
        for p, q, cell in self.grammar.row(kinds):
            _put(edits, (p, q), cell)
        return combined(combined(self.closure, edits), self.closure)

    def span(self, kinds: str) -> Table:
        level = [self.short(kinds[i : i + _BLOCK]) for i in range(0, len(kinds), _BLOCK)]
        return self.joined(level or [self.closure])

    @staticmethod
    def joined(level: list[Table]) -> Table:
        while len(level) > 1:
            pairs = [combined(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = pairs + level[len(pairs) * 2 :]
        return level[0]

    def best(self, table: Table) -> Cell:
        return min(table[self.grammar.start, q] for q in self.grammar.accepting if (self.grammar.start, q) in table)


_CELLS = "array<struct<p:int,q:int,cost:bigint,audit:string,roles:string>>"
_PARTS = "array<struct<part:bigint,at:bigint,n:bigint>>"
_SPAN = f"_conv string, part bigint, first string, last string, illegal bigint, parts {_PARTS}, cells {_CELLS}"
_VERDICT = f"_conv string, illegal bigint, cost bigint, audit string, roles string, parts {_PARTS}"
_EDIT = "part bigint, at bigint, pos bigint, edit string, role string, before string, after string"


def _cells(table: Table) -> list[dict]:
    return [
        {"p": p, "q": q, "cost": c, "audit": a, "roles": r} for (p, q), (c, a, r) in table.items()
    ]


def _table(cells: list[dict]) -> Table:
    return {(x["p"], x["q"]): (x["cost"], x["audit"], x["roles"]) for x in cells}


def _arrow(schema: str) -> pa.Schema:
    """Made in the driver and sent along: workers cannot read DDL."""
    return to_arrow_schema(StructType.fromDDL(schema))


def _parse(grammar: Grammar):
    """Spans of one partition to their tables."""
    schema = _arrow(_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, legal = Parser(grammar), grammar.neighbours()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                kinds, initials = row["kinds"], row["initials"]
                pairs = zip(initials, initials[1:], strict=False)
                out.append(
                    {
                        "_conv": row["_conv"],
                        "part": row["part"],
                        "first": initials[0],
                        "last": initials[-1],
                        "illegal": sum(a + b not in legal for a, b in pairs),
                        "parts": [{"part": row["part"], "at": row["at"], "n": len(kinds)}],
                        "cells": _cells(parser.span(kinds)),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _combine(grammar: Grammar):
    """Neighbouring spans of one conversation to one."""
    schema = _arrow(_SPAN)

    def run(spans: pa.Table) -> pa.Table:
        rows = sorted(spans.to_pylist(), key=lambda x: x["part"])
        legal = grammar.neighbours()
        edges = zip(rows, rows[1:], strict=False)
        whole = {
            "_conv": rows[0]["_conv"],
            "part": rows[0]["part"],
            "first": rows[0]["first"],
            "last": rows[-1]["last"],
            "illegal": sum(x["illegal"] for x in rows)
            + sum(a["last"] + b["first"] not in legal for a, b in edges),
            "parts": [p for x in rows for p in x["parts"]],
            "cells": _cells(Parser.joined([_table(x["cells"]) for x in rows])),
        }
        return pa.Table.from_pylist([whole], schema=schema)

    return run


def _best(grammar: Grammar):
    """The cheapest derivation of each whole conversation."""
    schema = _arrow(_VERDICT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(grammar)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cost, audit, roles = parser.best(_table(row["cells"]))
                kept = {k: row[k] for k in ("_conv", "illegal", "parts")}
                out.append(kept | {"cost": cost, "audit": audit, "roles": roles})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


#: One edited row with the rows inserted before it.
_EDITED = re.compile(f"{INSERT}*[^{INSERT}]")


def _edits():
    """Audits to one row for each original row, named by partition and place in it."""
    schema = _arrow(_EDIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                audit, roles = row["audit"], row["roles"]
                places = ((p["part"], p["at"] + i) for p in row["parts"] for i in range(p["n"]))
                out, pos, end = [], 0, 0
                for (part, at), found in zip(places, _EDITED.finditer(audit), strict=True):
                    end = found.end()
                    inserted = end - found.start() - 1
                    before = roles[pos : pos + inserted]
                    edit = audit[end - 1]
                    stays = edit != DELETE
                    role = roles[pos + inserted] if stays else None
                    out.append([part, at, pos, edit, role, before, ""])
                    pos += inserted + stays
                    if len(out) > 20_000:  # the last one may still get what follows it
                        yield _batch(out[:-1], schema)
                        out = out[-1:]
                if out:
                    out[-1][-1] = roles[pos : pos + len(audit) - end]
                    yield _batch(out, schema)

    return run


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema
    )


def _conv(conv_id: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


@dataclass(frozen=True)
class Repaired:
    """``verdicts``: one row per conversation with a row. ``rows``: what remains of conversations,
    ``conv_id, pos, turn, role, text, edit``; inserted rows have no turn and an empty text."""

    verdicts: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame, *, grammar: Grammar = DIALOGUE, fan_in: int = FAN_IN) -> Repaired:
    """The cheapest edits that make every conversation a sequence of ``grammar``.

    Takes ``conv_id, turn, role, text``; other columns are left out. Rows are in order of turn, null
    first; rows of one turn by role, the text's first 64 characters, its md5. A null role or text is
    one space; rows without ``conv_id`` are one conversation. A row's first fault counts: ``blank``
    (nothing but white space), ``duplicate`` (role and text stand earlier in the conversation),
    ``truncated`` (its last character that is not white space is not one of ``.!?``). Blank and
    duplicate rows are deleted. Verdicts have ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit``; ``gaps`` is null where it does not fit a long. An empty table gives none.
    """
    legal = sorted(grammar.initials)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = cut_lineage(
        conversations.select(
            "conv_id",
            _conv(F.col("conv_id")).alias("_conv"),
            F.col("turn").cast("long").alias("turn"),
            role.alias("role"),
            text.alias("text"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    slim = rows.select(
        "conv_id",
        "_conv",
        "turn",
        "role",
        F.substring("text", 1, 64).alias("_head"),
        F.md5(F.col("text").cast("binary")).alias("_digest"),
        "_row",
        (last == "").alias("_blank"),
        (~last.isin(".", "!", "?")).alias("_cut"),
    )
    # Rows of one role and text differ in turn only: the first one is the smallest (turn, row).
    again = (
        slim.filter("NOT _blank")
        .groupBy("_conv", "role", "_digest")
        .agg(F.count("*").alias("_n"), F.min(F.struct("turn", "_row")).alias("_first"))
        .filter("_n > 1")
        .select("_conv", "role", "_digest", F.col("_first._row").alias("_first"))
    )
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin(legal), initial).otherwise(OTHER)
    fault = (
        F.when(F.col("_blank"), "blank")
        .when(F.col("_first") != F.col("_row"), "duplicate")
        .when(F.col("_cut"), "truncated")
    )
    ordered = (
        slim.join(again, ["_conv", "role", "_digest"], "left")
        .orderBy("_conv", F.asc_nulls_first("turn"), "role", "_head", "_digest", "_row")
        .withColumn("_place", F.monotonically_increasing_id())
        .select("conv_id", "_conv", "turn", "_row", "_place", initial.alias("_initial"), fault.alias("fault"))
    )
    placed = cut_lineage(ordered).withColumns(
        {
            "part": F.shiftright("_place", _POSITION_BITS),
            "at": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    gone = F.col("fault").isin("blank", "duplicate")
    cut = F.when(F.col("_initial") == OTHER, CUT_OTHER).otherwise(F.upper("_initial"))
    kind = F.when(gone, GONE).when(F.col("fault") == "truncated", cut).otherwise(F.col("_initial"))
    cells = placed.groupBy("_conv", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", kind.alias("kind"), F.col("_initial").alias("initial")))).alias("x"),
        F.min("at").alias("at"),
    )
    letters = cells.select(
        "_conv",
        "part",
        "at",
        F.array_join("x.kind", "").alias("kinds"),
        F.array_join("x.initial", "").alias("initials"),
    )
    spans = cut_lineage(letters.mapInArrow(_parse(grammar), _SPAN))
    by_conv = Window.partitionBy("_conv")
    spans = spans.withColumn("_n", F.count("*").over(by_conv))
    whole = spans.filter("_n = 1").drop("_n")
    several = spans.filter("_n > 1").withColumn("part", F.row_number().over(by_conv.orderBy("part")) - 1)
    several = cut_lineage(several.withColumn("part", F.col("part").cast("long")).drop("_n"))
    left = (several.agg(F.max("part")).first()[0] or 0) + (0 if several.isEmpty() else 1)
    while left > 1:
        several = several.withColumn("part", F.expr(f"part div {fan_in}"))
        several = several.groupBy("_conv", "part").applyInArrow(_combine(grammar), _SPAN)
        left = -(-left // fan_in)
    best = whole.unionByName(several).mapInArrow(_best(grammar), _VERDICT)
    best = cut_lineage(best)

    turns = placed.groupBy("_conv", "turn").agg(
        F.first("conv_id").alias("conv_id"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")
    counts = turns.groupBy("_conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(gaps, F.lit(0)).try_cast("long").alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    verdicts = counts.join(best.drop("roles", "parts"), "_conv").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    edits = best.select("audit", "roles", "parts").mapInArrow(_edits(), _EDIT)
    marked = edits.join(placed.select("conv_id", "part", "at", "_row"), ["part", "at"])
    name = lambda c: F.create_map(*[F.lit(x) for pair in grammar.roles for x in pair])[c]
    new = lambda roles, pos: F.transform(
        F.filter(F.split(roles, ""), lambda c: c != ""),
        lambda c, i: F.struct(
            (pos + i).alias("pos"),
            F.lit(None).cast("long").alias("own"),
            name(c).alias("new_role"),
            F.lit(INSERT).alias("edit"),
        ),
    )
    pos, before = F.col("pos"), F.length("before")
    stays = F.col("edit") != DELETE
    own = F.struct(
        (pos + before).alias("pos"),
        F.col("_row").alias("own"),
        F.when(F.col("edit") == REROLE, name(F.col("role"))).alias("new_role"),
        F.col("edit").alias("edit"),
    )
    lists = F.concat(
        new("before", pos),
        F.when(stays, F.array(own)).otherwise(F.array().cast(_OUT)),
        new("after", pos + before + stays.cast("int")),
    )
    out = marked.select("conv_id", F.inline(lists))
    kept = out.filter("own IS NOT NULL").drop("conv_id").join(
        rows.select("conv_id", F.col("_row").alias("own"), "turn", "role", "text"), "own"
    )
    columns = ["conv_id", "pos", "turn", "role", "text", "edit"]
    added = out.filter("own IS NULL").withColumns(
        {"turn": F.lit(None).cast("long"), "role": F.col("new_role"), "text": F.lit("")}
    )
    kept = kept.withColumn("role", F.coalesce("new_role", "role"))
    return Repaired(verdicts, kept.select(*columns).unionByName(added.select(*columns)))


_OUT = "array<struct<pos:bigint,own:bigint,new_role:string,edit:string>>"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None
    schema = pa.schema({"_conv": pa.string(), "repaired_sha256": pa.string()})
    for batch in batches:
        out = []
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if out:
            yield _batch(out, schema)
    if now is not None:
        yield _batch([(now, state.hexdigest())], schema)


def digests(rows: DataFrame) -> DataFrame:
    """``_conv, repaired_sha256``: SHA-256 of ``role:text`` of a conversation's rows, one a line.

    A hash reads its input in order, so one task streams through a conversation; it keeps only the
    state of the hash.
    """
    keyed = rows.select(_conv(F.col("conv_id")).alias("_conv"), "pos", "role", "text")
    ordered = keyed.repartition("_conv").sortWithinPartitions("_conv", "pos").drop("pos")
    return ordered.mapInArrow(_digest, "_conv string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with rows dropped, emptied, cut, repeated or given to the user, by the
    crc32 of ``conv_id:turn``. Nulls count, and become, one space."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("_code"))
        .filter("_code <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_code") == 1, "")
            .when(F.col("_code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("_code") == 3, 2).otherwise(1))).alias("_copy"),
        )
        .drop("_copy")
    )


def repaired_digest(conversations: DataFrame, fixed: Repaired) -> DataFrame:
    """One row for every ``conv_id`` of ``conversations``; those without a verdict had no rows."""
    every = conversations.select("conv_id").distinct().withColumn("_conv", _conv(F.col("conv_id")))
    verdicts = fixed.verdicts.withColumn("_conv", _conv(F.col("conv_id"))).drop("conv_id")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    unknown = F.col("audit").isNull()
    return (
        every.join(verdicts, "_conv", "left")
        .join(digests(fixed.rows), "_conv", "left")
        .select(
            "conv_id",
            *[F.when(unknown, 0).otherwise(F.col(c)).alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )
