import random

import pytest

from rillhouse.operators import merge

COLUMNS = "id int, v string, seq int, type string"
KINDS = ["insert", "bootstrap-insert", "update", "delete"]


def apply_in_order(target, changes, policy):
    """What the policies mean, one change at a time."""
    table = dict(target)
    for key, value, _, kind in sorted(changes, key=lambda c: c[2]):
        if kind == "delete":
            table.pop(key, None)
        elif key in table:
            if policy.replaces is None or kind in policy.replaces:
                table[key] = value
        elif policy.creates is None or kind in policy.creates:
            table[key] = value
    return table


@pytest.mark.parametrize("policy", [merge.STRICT, merge.UPSERT, merge.REPLACE])
def test_equals_applying_one_by_one(spark, policy):
    rng = random.Random(7)
    target = [(k, f"t{k}") for k in range(0, 400, 2)]
    changes, seq = [], 0
    for key in range(400):
        for _ in range(rng.randrange(0, 6)):
            seq += 1
            changes.append((key, rng.choice([f"c{seq}", None]), seq, rng.choice(KINDS)))
    changes += [(7, f"hot{n}", 10_000 + n, rng.choice(KINDS)) for n in range(500)]   # a busy key
    rng.shuffle(changes)
    got = merge.apply_changes(
        spark.createDataFrame(target, "id int, v string"),
        spark.createDataFrame(changes, COLUMNS), "id", ["seq"], policy=policy)
    assert got.columns == ["id", "v"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len({r[0] for r in rows})
    assert dict(rows) == apply_in_order(target, changes, policy)


def test_applying_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    changes = spark.createDataFrame(
        [(1, "a2", 1, "update"), (2, None, 2, "delete"), (4, "d", 3, "insert"), (4, "d2", 4, "update"),
         (9, "x", 5, "update")], COLUMNS)
    once = merge.apply_changes(target, changes, "id", ["seq"])
    assert sorted(map(tuple, once.collect())) == [(1, "a2"), (3, "c"), (4, "d2")]
    twice = merge.apply_changes(once, changes, "id", ["seq"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_unmatched_delete_is_never_inserted(spark):
    target = spark.createDataFrame([], "id int, v string")
    changes = spark.createDataFrame([(5, "x", 1, "delete")], COLUMNS)
    for policy in (merge.STRICT, merge.UPSERT, merge.REPLACE):
        assert merge.apply_changes(target, changes, "id", ["seq"], policy=policy).count() == 0


def test_upsert_replace_with_null_keys(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, j string, n int")
    new = spark.createDataFrame([("a", None, 9), ("c", None, 3)], "k string, j string, n int")
    got = merge.upsert_replace(old, new, ["k", "j"])
    assert sorted(((r.k, r.n) for r in got.collect())) == [("a", 9), ("b", 2), ("c", 3)]
