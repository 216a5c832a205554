"""Updates after late, repeated and withdrawn events give the tables of a full run."""

from collections import Counter
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from checks import queries as checked
from checks.present import shown
from checks.queries import RUN
from playerlens.plans import incremental, layers
from playerlens.sinks import tables
from tests.test_staging import at, raw_rows

DAY = 86_400


def stored(spark, root, rows):
    raw = raw_rows(spark, rows).withColumn("event_date", F.to_date("event_timestamp"))
    tables.write_table(raw, layers.stored_path(root, "raw_events"), partition="event_date")


def contents(spark, root):
    out = {}
    for plan in layers.TABLES:
        df = layers.open_table(spark, root, plan.name)
        keep = [c for c, kind in df.dtypes if kind != "binary"]
        out[plan.name] = Counter(map(str, shown(df.select(*sorted(keep))).collect()))
    return out


def files(root, name):
    """Data files of a table by partition."""
    out = {}
    for f in Path(layers.stored_path(root, name)).rglob("*.parquet"):
        out.setdefault(f.parent.name, set()).add(f.name)
    return out


def first(d):
    return date(2024, 3, d)


def on(player, seconds, **more):
    """An event so many seconds after the first of March began."""
    return at(player, seconds - DAY // 2, **more)


BASE = [
    on("a", 100), on("a", 900, event_name="level_end", param_level=2),
    on("a", DAY - 600), on("a", DAY + 600),  # over midnight
    on("a", 2 * DAY), on("a", 4 * DAY),
    on("b", 50), on("b", 3000), on("b", 3 * DAY),
    on("c", 2 * DAY + 7, event_name="post_score", param_level=1, param_score=5),
]
LATE = [
    on("b", 1500),  # joins two sessions
    on("d", 6 * DAY, event_value_in_usd=2.0),  # a new player on a new day
    on("c", 5), on("z", 10),  # before all others
    on("a", DAY - 2400), on("a", DAY + 1800),  # on both sides of midnight
    on("a", 100), on("b", 3 * DAY, event_name="post_score", param_score=9),  # again, and another one
]


def test_an_update_equals_a_full_run(spark, tmp_path):
    updated, whole = f"{tmp_path}/updated", f"{tmp_path}/whole"
    stored(spark, updated, BASE)
    layers.run_layers(spark, updated, settings=RUN)
    before = {n: files(updated, n) for n in ("stg_events", "fact_events")}
    for root in (updated, whole):
        stored(spark, root, BASE + LATE)
    days = [1, 2, 4, 7]
    report = incremental.update_layers(spark, updated, [first(d) for d in days], RUN)
    assert {r["status"] for r in report.values()} == {"success"}
    layers.run_layers(spark, whole, settings=RUN)
    assert contents(spark, updated) == contents(spark, whole)
    touched = {f"event_date={first(d)}" for d in days}
    for name, was in before.items():
        kept = {p: f for p, f in was.items() if p not in touched}
        assert kept and {p: f for p, f in files(updated, name).items() if p not in touched} == kept


def test_withdrawn_events(spark, tmp_path):
    """A day loaded again without some of its events, and a day that has none any more."""
    updated, whole = f"{tmp_path}/updated", f"{tmp_path}/whole"
    stored(spark, updated, BASE)
    layers.run_layers(spark, updated, settings=RUN)
    left = [r for r in BASE if r not in (BASE[2], BASE[4], BASE[9])]
    for root in (updated, whole):
        stored(spark, root, left)
    incremental.update_layers(spark, updated, [first(1), first(3)], RUN)
    layers.run_layers(spark, whole, settings=RUN)
    assert contents(spark, updated) == contents(spark, whole)
    assert f"event_date={first(3)}" not in files(updated, "stg_events")


def test_predictions_and_other_days_stay(spark, tmp_path):
    root = f"{tmp_path}/updated"
    stored(spark, root, BASE)
    layers.run_layers(spark, root, settings=RUN)
    path = layers.stored_path(root, "dim_users")
    tables.rewrite_table(layers.open_table(spark, root, "dim_users").withColumns({"player_segment": F.lit("x"), "risk_tier": F.lit("low")}), path)
    before = files(root, "fact_sessions")
    stored(spark, root, [*BASE, on("b", 1500)])
    incremental.update_layers(spark, root, [first(1)], RUN)
    users = {r["user_pseudo_id"]: (r["player_segment"], r["total_events"]) for r in layers.open_table(spark, root, "dim_users").collect()}
    assert users == {"a": ("x", 6), "b": ("x", 4), "c": ("x", 1)}
    # Two sessions of that day are one now, and b's later one has another number.
    same = {p for p, f in files(root, "fact_sessions").items() if before.get(p) == f}
    assert same == set(before) - {f"session_date={first(1)}", f"session_date={first(4)}"}
    assert incremental.update_layers(spark, root, [], RUN) == {}


def test_rows_are_compared_in_one_pass(spark):
    """Repeated rows count as often as they occur, and missing values are equal."""
    a, b = (spark.createDataFrame(r, "x int, y string") for r in ([(1, "a"), (1, "a"), (2, None)], [(2, None), (1, "a"), (3, "c")]))
    got = {(r.x, r.y): (r["_rows"], r["_more"]) for r in checked._row_differences(a, b.select("y", "x")).collect()}
    assert got == {(1, "a"): (2, 1), (2, None): (1, 0), (3, "c"): (0, -1)}
