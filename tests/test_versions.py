"""Versioned tables: claims, buckets, history, days and the ledger's state."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks
from ledgerloom.operators.history import apply_snapshot, empty_history
from ledgerloom.params import Params
from ledgerloom.plans import inventory
from ledgerloom.plans.ledger_state import LedgerState
from ledgerloom.plans.model_checks import mart_checks, model_checks
from ledgerloom.plans.order_days import OrderDays
from ledgerloom.sinks import buckets, manifest
from ledgerloom.sinks.buckets import Buckets
from ledgerloom.sinks.day_state import DayState, fingerprints
from ledgerloom.sinks.history_table import CLOSED_PARTS, HistoryTable
from ledgerloom.sinks.tables import drop_days, write_days

KEYS = "id string, value string, _ingest_date string, _loaded_at string"
DAY = dt.date(2020, 1, 1)


def data_files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def publish(spark, path, text, owner=""):
    with manifest.writing(spark, path, owner) as draft:
        spark.range(1).selectExpr(f"'{text}' AS x").write.parquet(f"{path}/{draft.folder}")
        return draft.publish({"all": draft.folder})


def texts(spark, path):
    version = manifest.newest(spark, path)
    return [r["x"] for r in manifest.read_parts(spark, path, version.parts, "x string").collect()]


# Manifests


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path)
    assert texts(spark, path) == [] and manifest.newest(spark, path).number == 0
    for n in range(1, 5):
        assert publish(spark, path, f"t{n}").number == n
        assert texts(spark, path) == [f"t{n}"]
    # The current version and the one before it are kept.
    assert manifest.numbers(spark, path) == [3, 4]
    assert sorted(p.name for p in (tmp_path / "data").iterdir()) == ["0000000003", "0000000004"]


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path)
    publish(spark, path, "old")
    with pytest.raises(RuntimeError, match="killed"):
        with manifest.writing(spark, path) as draft:
            spark.range(5).selectExpr("'new' AS x").write.parquet(f"{path}/{draft.folder}")
            raise RuntimeError("killed")
    assert texts(spark, path) == ["old"]
    # The next writer takes the same number; what is left of the dead one's data is overwritten.
    with manifest.writing(spark, path) as draft:
        assert draft.number == 2


def test_of_two_writers_one_stops(spark, tmp_path):
    path = str(tmp_path)
    now = dt.datetime(2020, 1, 1, 12)
    with manifest.writing(spark, path, "run one", now) as first:
        with pytest.raises(manifest.ConcurrentWrite, match="run one has been writing version 1"):
            with manifest.writing(spark, path, "run two", now + dt.timedelta(hours=1)):
                pass
        first.publish({})
    with manifest.writing(spark, path, "run two") as second:
        assert second.number == 2


def test_a_claim_of_a_dead_run_is_taken_over(spark, tmp_path):
    path = str(tmp_path)
    claim = tmp_path / "_versions" / "0000000001.claim"
    claim.parent.mkdir()
    claim.write_text("run one 2020-01-01T12:00:00")
    later = dt.datetime(2020, 1, 1, 12) + manifest.STALE
    with pytest.raises(manifest.ConcurrentWrite):
        with manifest.writing(spark, path, "run two", later - dt.timedelta(seconds=1)):
            pass
    with manifest.writing(spark, path, "run two", later) as draft:
        draft.publish({})
    assert manifest.newest(spark, path).number == 1 and not claim.exists()


def test_a_version_published_meanwhile_is_noticed(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    publish(spark, path, "one")
    stale = manifest.newest(spark, path)
    publish(spark, path, "two")
    real, seen = manifest.newest, []
    monkeypatch.setattr(manifest, "newest", lambda *a: seen.append(1) or (
        stale if len(seen) == 1 else real(*a)))
    with pytest.raises(manifest.ConcurrentWrite, match="meanwhile"):
        with manifest.writing(spark, path):
            pass


# Buckets


def test_a_batch_rewrites_only_its_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = Buckets(spark, path, KEYS, ("id",), 16)

    def batch(*found):
        return spark.createDataFrame([(*r, "00:00:00") for r in found], KEYS)

    first = [(f"k{i}", "a", "2020-01-05") for i in range(200)]
    assert len(table.merge_latest(batch(*first), ("value",))) == 16
    before = data_files(path)
    changed = table.merge_latest(batch(("k1", "b", "2020-01-06"), ("k2", "old", "2020-01-01"),
                                       ("new", "c", "2020-01-02"), ("k1", "a", "2020-01-04")), ("value",))
    assert 1 <= len(changed) <= 2
    version = manifest.newest(spark, path)
    assert {n for n, f in version.parts.items() if f.startswith("data/0000000002")} == {
        str(b) for b in changed}
    kept = data_files(path)
    assert all(kept[p] == before[p] for p in before)  # nothing else was touched
    # Replays and older rows write nothing.
    for again in (batch(*first), batch(("k1", "b", "2020-01-06")), batch(*first[:3])):
        assert table.merge_latest(again, ("value",)) == []
    assert data_files(path) == kept
    got = {r["id"]: r["value"] for r in table.read().collect()}
    assert got == {**{k: v for k, v, _ in first}, "k1": "b", "new": "c"}
    assert rows(table.read(only=changed)) == sorted(
        [tuple(r) for r in table.read().collect()
         if int(spark.range(1).select(F.pmod(F.xxhash64(F.lit(r["id"])), F.lit(16))).first()[0])
         in changed], key=repr)


def test_buckets_are_dealt_anew(spark, rows, tmp_path):
    table = Buckets(spark, str(tmp_path), KEYS, ("id",), 4)
    data = spark.createDataFrame([(None if i == 3 else f"k{i}", "a", "2020", "x") for i in range(50)], KEYS)
    table.merge_latest(data, ("value",))
    before = rows(table.read())
    table.rebucket(9)
    version = manifest.newest(spark, str(tmp_path))
    assert len(version.parts) == 9 and rows(table.read()) == before
    # The stored number counts, whatever a caller thinks it is.
    assert table.merge_latest(data, ("value",)) == []


# History


def test_history_equals_the_plain_one_and_rests_when_nothing_changes(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerloom.sinks.history_table.CLOSED_PARTS", 3)
    schema = "id string, kind string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    table = HistoryTable(spark, str(tmp_path), "id", ("kind",), schema, 8)
    rnd, state = random.Random(4), {f"k{i}": "a" for i in range(40)}
    plain = None
    for step in range(7):
        for key in rnd.sample(sorted(state), 2):
            state[key] = rnd.choice([None, "a", "b", "c"])
        state.pop(rnd.choice(sorted(state)))
        state[f"k{rnd.randint(0, 60)}"] = "d"
        snapshot = spark.createDataFrame([(k, v, "x") for k, v in state.items()],
                                         "id string, kind string, other string")
        at = dt.datetime(2020, 1, 1 + step)
        plain = empty_history(snapshot.select("id", "kind")) if plain is None else plain
        plain = spark.createDataFrame(apply_snapshot(plain, snapshot, "id", ["kind"], at).collect(), schema)
        changed = table.apply(snapshot, at)
        assert len(changed) <= (8 if not step else 4)
        assert rows(table.read()) == rows(plain)
        before = data_files(tmp_path)
        assert table.apply(snapshot, at + dt.timedelta(hours=1)) == []
        assert data_files(tmp_path) == before
    closed = [n for n in manifest.newest(spark, str(tmp_path)).parts if n.startswith("closed")]
    assert 1 <= len(closed) <= 3 < CLOSED_PARTS


# Days


SALES = "order_date date, product_id string, units bigint"


def sales(spark, *found):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d), p, u) for d, p, u in found], SALES)


def test_an_unchanged_day_is_not_read_and_a_broken_one_fails(spark, tmp_path):
    path = str(tmp_path / "fact")
    rules = [checks.in_range("fact", "units", 0), checks.unique("fact", "order_date", "product_id"),
             checks.min_rows("fact", 1)]
    state = DayState(spark, str(tmp_path / "state"), f"order_date date, {checks.DAY_COUNTS}", path,
                     SALES, "order_date", "v1")
    read = []

    def count(days):
        plan = days._jdf.queryExecution().executedPlan().toString()
        read.append((sorted(r[0] for r in days.select("order_date").distinct().collect()), plan))
        return checks.day_counts(days, "order_date", rules)

    def judge():
        state.refresh(count)
        return {r["test"]: (r["failing_rows"], r["status"])
                for r in checks.judge_days(state.read(), "s", rules, ["fact.*.row_count"]).collect()}

    assert judge()["row_count"] == (1, "warn")
    write_days(sales(spark, *[(d, p, 1) for d in range(6) for p in "abc"]), path, "order_date")
    assert set(judge().values()) == {(0, "pass")}
    assert judge() and len(read) == 2  # nothing changed: no day was read
    # An old day breaks: a negative number, and a key twice.
    write_days(sales(spark, (1, "a", -1), (1, "a", 2), (1, "b", 1)), path, "order_date")
    got = judge()
    assert got["accepted_range"] == (1, "fail") and got["unique_combination"] == (1, "fail")
    days, plan = read[-1]
    assert days == [DAY + dt.timedelta(days=1)]
    assert "PartitionFilters" in plan and "2020-01-02" in plan and "2020-01-03" not in plan
    # It stays broken for runs that change other days, until it is mended or gone.
    write_days(sales(spark, (5, "a", 4)), path, "order_date")
    assert judge()["accepted_range"] == (1, "fail") and read[-1][0] == [DAY + dt.timedelta(days=5)]
    drop_days(spark, path, "order_date", [DAY + dt.timedelta(days=1)])
    assert set(judge().values()) == {(0, "pass")}
    # Other rules judge all days anew.
    other = DayState(*[getattr(state, f) for f in ("spark", "path", "schema", "source",
                                                   "source_schema", "day")], "v2")
    assert len(other.refresh(count)) == 5


def test_day_counts_need_a_key_with_the_day(spark):
    with pytest.raises(ValueError):
        checks.day_counts(sales(spark, (0, "a", 1)), "order_date", [checks.unique("fact", "product_id")])


def test_days_are_told_by_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert fingerprints(spark, path, "order_date") == {}
    write_days(sales(spark, (0, "a", 1), (1, "a", 1)), path, "order_date")
    first = fingerprints(spark, path, "order_date")
    write_days(sales(spark, (1, "a", 1)), path, "order_date")
    second = fingerprints(spark, path, "order_date")
    assert set(first) == set(second) == {DAY, DAY + dt.timedelta(days=1)}
    assert first[DAY] == second[DAY] and first[max(first)] != second[max(second)]


# Ledger


PARAMS = Params(min_opening_stock=1000)
LEDGER = [c for c in mart_checks() if c.model == "int_inventory_position"]


def test_the_ledgers_state_equals_the_full_build(spark, rows, tmp_path):
    path, schema = str(tmp_path / "daily"), "order_date date, product_id string, units_sold bigint, revenue decimal(28,2)"
    attributes = spark.createDataFrame([("a", "x", "X"), ("b", "y", "Y")],
                                       "product_id string, category_pt string, category_en string")
    state = LedgerState(spark, str(tmp_path / "state"), path, schema, PARAMS)

    def write(*found):
        write_days(spark.createDataFrame(
            [(DAY + dt.timedelta(days=d), p, u) for d, p, u in found],
            "order_date date, product_id string, units_sold bigint").withColumn(
                "revenue", F.lit(1).cast("decimal(28,2)")), path, "order_date")

    def check():
        daily = state.daily()
        want = inventory.inventory_health_closed(daily, PARAMS, attributes)
        assert rows(state.health(attributes)) == rows(want)
        dense = inventory.inventory_position(daily, PARAMS, attributes)
        expected = checks.run_checks("model", {LEDGER[0].model: dense}, LEDGER)
        got = state.checks(LEDGER, attributes)
        assert rows(got) == rows(expected)
        return {r["test"]: r["failing_rows"] for r in got.collect()}

    rnd = random.Random(2)
    state.refresh()
    assert state.health(attributes).count() == 0
    write(*[(d, p, rnd.randint(1, 3)) for d in range(5, 60) for p in "ab"])
    assert state.refresh() == [0, 1, 2, 3] and not any(check().values())
    write((60, "a", 2), (61, "c", 5))  # new days, a new product
    assert state.refresh() == [3, 4] and not any(check().values())
    write((20, "a", 1), (20, "b", 90))  # a late order
    assert state.refresh() == [1]
    check()
    write((21, "b", 4000))  # far more than there was: the ledger's range check fails on many days
    assert state.refresh() == [1] and check()["accepted_range"] > 0
    drop_days(spark, path, "order_date", [DAY + dt.timedelta(days=21)])  # deleted orders
    assert state.refresh() == [1]
    check()
    write((2, "a", 1))  # the first day moves: intervals are counted from it
    assert len(state.refresh()) == 5
    check()
    assert state.refresh() == []
    known = spark.createDataFrame([("a",), ("b",)], "id string")
    assert state.orphans(known, "id").first()[0] == 1


# Order days


def test_days_that_orders_leave(spark, tmp_path):
    index = OrderDays(spark, str(tmp_path), 8)
    schema = "order_id string, order_date date, _ingest_date string, _loaded_at string"

    def update(*found):
        index.update(spark.createDataFrame(
            [(o, DAY + dt.timedelta(days=d), f"2020-02-{at:02}", "x") for o, d, at in found], schema))
        return [(d - DAY).days for d in index.left()]

    assert not index.exists()
    assert update(("o1", 0, 1), ("o2", 0, 1), ("o1", 0, 2)) == []
    assert update(("o1", 30, 3)) == [0]
    assert update(("o1", 0, 2)) == [0]  # an older snapshot, read again
    assert update(("o2", 5, 4), ("o3", 5, 4), ("o1", 31, 5)) == [0, 30]
    headers = spark.createDataFrame(
        [(o, DAY + dt.timedelta(days=d)) for o, d in (("o1", 0), ("o1", 31), ("o2", 5), ("o9", 1))],
        "order_id string, order_date date")
    assert sorted((r[0], (r[1] - DAY).days) for r in index.counting(headers).collect()) == [
        ("o1", 31), ("o2", 5), ("o9", 1)]
    index.rebuilt([DAY])
    assert index.left() == [DAY + dt.timedelta(days=30)]


def test_a_batch_is_ranked_once_with_the_stored_rows(spark, rows, tmp_path, monkeypatch):
    """Also by the index of order days; and a row with a null key is replaced, not doubled."""
    calls, real = [], buckets.latest_wins
    monkeypatch.setattr(buckets, "latest_wins", lambda *a, **k: calls.append(1) or real(*a, **k))
    table = Buckets(spark, str(tmp_path / "t"), KEYS, ("id",), 4)

    def merge(*found):
        return table.merge_latest(spark.createDataFrame(
            [(k, v, at, "x") for k, v, at in found], KEYS), ("value",))

    merge((None, "a", "2020-01-01"), ("k", "a", "2020-01-01"), ("k", "b", "2020-01-02"))
    merge((None, "c", "2020-01-03"), (None, "b", "2020-01-02"))
    assert len(calls) == 2
    assert {(r["id"], r["value"]) for r in table.read().collect()} == {(None, "c"), ("k", "b")}
    assert table.read().count() == 2
    index = OrderDays(spark, str(tmp_path / "days"), 4)
    schema = "order_id string, order_date date, _ingest_date string, _loaded_at string"
    for day, at in ((0, "1"), (9, "2")):
        index.update(spark.createDataFrame(
            [(o, DAY + dt.timedelta(days=day), at, "x") for o in ("o1", None)], schema))
    assert len(calls) == 4 and index.left() == [DAY] and index.table.read().count() == 2


def test_suspects_take_the_md5_of_a_product_once_a_row(spark, tmp_path):
    schema = "order_date date, product_id string, units_sold bigint, revenue decimal(28,2)"
    source = str(tmp_path / "daily")
    # Some products have less stock than they sell on the first day.
    sold = [(DAY, f"p{i}", 500) for i in range(20)] + [(DAY + dt.timedelta(days=40), "p0", 1)]
    daily = spark.createDataFrame(sold, "order_date date, product_id string, units_sold bigint").selectExpr(
        "*", "CAST(1 AS decimal(28,2)) AS revenue")
    write_days(daily, source, "order_date")
    state = LedgerState(spark, str(tmp_path / "state"), source, schema, Params())
    state.refresh()
    own = [c for c in model_checks(Params()) if c.model == "int_inventory_position"]
    found = state.suspects(own)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") == 1
    attributes = spark.createDataFrame([], "product_id string, category_pt string, category_en string")
    bad = inventory.inventory_position(daily, Params(), attributes).filter(
        "on_hand_units < 0 OR sell_through_rate NOT BETWEEN 0 AND 1").select("product_id")
    assert 0 < found.count() < 20
    assert {r[0] for r in found.collect()} == {r[0] for r in bad.collect()}
