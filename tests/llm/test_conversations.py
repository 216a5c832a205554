"""Repair of conversations against a plain search, also for one that fills many partitions."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from playerlens.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\v\f\r"


def in_order(rows):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2][:64], md5(x[2])))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def searched(rows):
    """Cheapest edits row by row; up to three rows are inserted at any place."""

    def inserted(states):
        for _ in range(3):
            more = dict(states)
            for state, (cost, audit, made) in states.items():
                for c, name in NAMES.items():
                    if (state, c) in STEPS:
                        x = (cost + 2, audit + "I", [*made, f"{name}:"])
                        q = STEPS[state, c]
                        more[q] = min(more.get(q, x), x, key=lambda y: y[:2])
            states = more
        return states

    states = inserted({0: (0, "", [])})
    for (_, role, text), fault in zip(rows, faults(rows)):
        now = {}
        extra = int(fault == "truncated")
        for state, (cost, audit, made) in states.items():
            options = [(state, cost + 3, "D", None)]
            if fault not in ("blank", "duplicate"):
                options += [(STEPS[state, c], cost + 2 + extra, "R", f"{n}:{text}") for c, n in NAMES.items() if (state, c) in STEPS]
                if (state, role[:1]) in STEPS:
                    options.append((STEPS[state, role[:1]], cost + extra, "K", f"{role}:{text}"))
            for q, c, letter, line in options:
                x = (c, audit + letter, made + ([line] if line is not None else []))
                now[q] = min(now.get(q, x), x, key=lambda y: y[:2])
        states = inserted(now)
    return min((states[q] for q in (0, 3) if q in states), key=lambda y: y[:2])


def expected(table):
    out = {}
    for c in {r[0] for r in table}:
        rows = in_order([r[1:] for r in table if r[0] == c])
        cost, audit, made = searched(rows)
        found = faults(rows)
        turns = {t for t, _, _ in rows if t is not None}
        pairs = zip(rows, rows[1:])
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest(),
        )
    return out


def result(spark, table, extra=lambda df: df, **options):
    df = extra(spark.createDataFrame(table, SCHEMA))
    return {r[0]: tuple(r)[1:] for r in conv.repaired_digest(df, conv.repair(df, **options)).collect()}


def random_rows(rng, n, ids):
    roles = ["user", "assistant", "system", "tool", "User", "", None, "u"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "é?", "x" * 70 + "a.", "x" * 70 + "b."]
    weights = [9, 9, 2, 1, 1, 1, 1, 1]
    return [
        (rng.choice(ids), rng.choice([None, *range(9)]), rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}.")
        for _ in range(n)
    ]


def test_equals_a_plain_search(spark):
    table = random_rows(random.Random(1), 600, [None, *range(90)])
    assert result(spark, table) == expected(table)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(2)
    table = [(7, i if i % 50 else None, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Hi.", f"{i}.", f"{i}"])) for i in range(3000)]
    table += random_rows(rng, 40, [1, 8, 9])
    assert result(spark, table, fan_in=2) == expected(table)


def test_equal_rows_need_no_common_task(spark):
    table = [(1, 0, "user", "Same.")] * 500 + [(1, 1, "assistant", "Yes.")]
    assert result(spark, table) == expected(table)


def test_odd_tables(spark):
    assert result(spark, []) == {}
    long = "word " * 200_000
    big = 2**63 - 1
    table = [(1, None, None, None), (2, -big, "user", long), (2, big, "assistant", long + "."), (None, 0, "user", "A."), (None, 1, "assistant", "B.")]
    clash = lambda df: df.withColumns({c: F.lit("mine") for c in ("_conv", "part", "at", "cost", "pos", "edit")})
    got, want = result(spark, table, clash), expected(table)
    assert want[2][0] == 2 * big - 1 and got[2][0] is None  # does not fit
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}


def test_repaired_rows_are_a_sequence_of_the_grammar(spark):
    table = random_rows(random.Random(3), 300, list(range(40)))
    fixed = conv.repair(spark.createDataFrame(table, SCHEMA))
    rows = fixed.rows.orderBy("conv_id", "pos").collect()
    by_conv = {}
    for r in rows:
        assert r["pos"] == len(by_conv.setdefault(r["conv_id"], []))
        assert (r["edit"] == "I") == (r["turn"] is None and r["text"] == "" ) or r["turn"] is None
        by_conv[r["conv_id"]].append(r["role"][0])
    for roles in by_conv.values():
        state = 0
        for c in roles:
            state = STEPS[state, c]
        assert state in (0, 3)
    again = conv.repair(fixed.rows.withColumn("turn", F.col("pos")).filter("text <> ''"))
    untouched = {r["conv_id"] for r in fixed.verdicts.filter("audit NOT RLIKE '[IDR]' AND truncated = 0").collect()}
    assert all(r["cost"] == 0 for r in again.verdicts.collect() if r["conv_id"] in untouched)


def test_another_grammar(spark):
    """Two askers before each answer, told apart by the order of the roles only."""
    pairs = conv.Grammar(
        steps=((0, "q", 1), (1, "q", 2), (2, "r", 0)), accepting=(0,), roles=(("q", "question"), ("r", "reply")), insert=1
    )
    df = spark.createDataFrame([(1, 0, "question", "A?"), (1, 1, "reply", "B."), (2, 0, "reply", "C.")], SCHEMA)
    fixed = conv.repair(df, grammar=pairs)
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in fixed.verdicts.collect()} == {1: (1, "IKK"), 2: (2, "IIK")}
    rows = [(r["role"], r["text"]) for r in fixed.rows.filter("conv_id = 1").orderBy("pos").collect()]
    assert rows == [("question", ""), ("question", "A?"), ("reply", "B.")]
    with pytest.raises(ValueError):
        conv.Grammar(steps=((0, "A", 0),), accepting=(0,), roles=())


def test_damage(spark):
    table = [(c, t, ("user", "assistant", None)[t % 3], ("Hi. Yes!", None)[t % 2]) for c in (None, *range(30)) for t in range(8)]
    want = []
    for c, t, role, text in table:
        code = zlib.crc32(f"{' ' if c is None else c}:{t}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        row = (c, t, "user" if code == 4 else role, "" if code == 1 else "Hi Yes" if code == 2 and text != " " else text)
        want += [row] * {0: 0, 3: 2}.get(code, 1)
    got = [tuple(r) for r in conv.damaged(spark.createDataFrame(table, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_conversations_that_lose_all_rows_stay(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "A."), (gone, 0, "user", "B.")], SCHEMA)
    out = conv.repaired_digest(df, conv.repair(conv.damaged(df))).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
