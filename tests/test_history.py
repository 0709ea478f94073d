import datetime as dt

from ledgerloom.operators.history import apply_snapshot, empty_history

SCHEMA = "product_id string, category_pt string"


def at(day):
    return dt.datetime(2020, 1, day)


def test_life_of_products(spark, rows):
    snapshots = [
        [("same", "x"), ("changes", "x"), ("nulls", None), ("leaves", "x")],
        [("same", "x"), ("changes", "y"), ("nulls", None), ("new", "z")],
        [("same", "x"), ("changes", "y"), ("nulls", "n"), ("new", None), ("leaves", "x")],
        [("same", "x"), ("changes", "x"), ("nulls", None), ("leaves", "x")],
    ]
    frames = [spark.createDataFrame(s, SCHEMA) for s in snapshots]
    state = empty_history(frames[0])
    for i, frame in enumerate(frames):
        state = apply_snapshot(state, frame, "product_id", ["category_pt"], at(i + 1))
    want = [
        ("same", "x", at(1), None),
        ("changes", "x", at(1), at(2)), ("changes", "y", at(2), at(4)), ("changes", "x", at(4), None),
        ("nulls", None, at(1), at(3)), ("nulls", "n", at(3), at(4)), ("nulls", None, at(4), None),
        ("leaves", "x", at(1), at(2)), ("leaves", "x", at(3), None),
        ("new", "z", at(2), at(3)), ("new", None, at(3), at(4)),
    ]
    assert rows(state) == sorted(want, key=repr)


def test_same_snapshot_again_changes_nothing(spark, rows):
    frame = spark.createDataFrame([("a", "x"), ("b", None)], SCHEMA)
    once = apply_snapshot(empty_history(frame), frame, "product_id", ["category_pt"], at(1))
    assert rows(apply_snapshot(once, frame, "product_id", ["category_pt"], at(2))) == rows(once)
