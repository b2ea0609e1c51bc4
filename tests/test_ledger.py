"""Replay decisions against a plain simulation; failure routing."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import ledger as L


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "table string, seq bigint, token string")


def accepted_ledger(spark, rows):
    """rows: (seq, table, token, status)"""
    full = [(s, t, "l", k, 0, 1, st, 1, [], None) for s, t, k, st in rows]
    return spark.createDataFrame(full, L.LEDGER_SCHEMA)


def simulate(rows, ledger, window):
    """A token is a duplicate when the ledger counts it at the start, or when it came earlier."""
    seen = {}
    for seq, table, token, status in sorted(ledger):
        if status == L.ACCEPTED and token is not None:
            seen.setdefault(table, []).append(token)
    seen = {t: set(k if window is None else k[-window:]) for t, k in seen.items()}
    out = {}
    for table, seq, token in sorted(rows, key=lambda r: r[1]):
        known = seen.setdefault(table, set())
        out[table, seq] = token is None or token not in known
        known.add(token)
    return out


@pytest.mark.parametrize("window", [None, 1, 3, 10, 1000])
def test_dedup_agrees_with_a_simulation(spark, window):
    rng = random.Random(window)
    rows = [(rng.choice("abc"), i, rng.choice([None, *(f"t{n}" for n in range(12))])) for i in range(150)]
    past = [(i, rng.choice("abc"), f"t{rng.randrange(20)}", rng.choice([L.ACCEPTED, L.ACCEPTED, L.FAILED])) for i in range(60)]
    got = L.dedup(arrivals(spark, rows), accepted_ledger(spark, past), window).collect()
    assert {(r["table"], r["seq"]): r["accepted"] for r in got} == simulate(rows, past, window)
    assert len(got) == len(rows)


def test_window_zero_and_fresh_tokens(spark):
    rows = [("a", 0, "x"), ("a", 1, "x")]
    assert [r["accepted"] for r in L.dedup(arrivals(spark, rows), accepted_ledger(spark, []), 0).collect()] == [True, True]
    fresh = [("a", i, f"t{i}") for i in range(5)]
    assert all(r["accepted"] for r in L.dedup(arrivals(spark, fresh), accepted_ledger(spark, []), 2).collect())
    with pytest.raises(ValueError):
        L.dedup(arrivals(spark, rows), accepted_ledger(spark, []), -1)


def test_recent_tokens(spark):
    past = [(i, "ab"[i % 2], f"t{i}", L.FAILED if i == 18 else L.ACCEPTED) for i in range(20)]
    got = {(r["table"], r["token"]): r["age"] for r in L.recent_tokens(accepted_ledger(spark, past), 3).collect()}
    assert got == {("a", "t16"): 1, ("a", "t14"): 2, ("a", "t12"): 3, ("b", "t19"): 1, ("b", "t17"): 2, ("b", "t15"): 3}


def chains(spark, *causes):
    rows = [(i, c) for i, c in enumerate(causes)]
    return spark.createDataFrame(rows, f"id int, causes array<{L.CAUSE}>").orderBy("id")


def test_classification(spark):
    yes = [[("connect", None, "refused")], [("wrapper", None, None), ("connect", None, "refused")], [("transport", None, "reset")], [("transfer", None, "broken pipe")],
           [("server", 252, "Too many parts")], [("client", None, "x"), ("server", 241, "Memory limit")]]
    no = [[("client", None, "bad option")], [("IllegalState", None, "other")], [("server", 60, "Table not found")], [("server", 117, "Unknown field")], [],
          [("server", 60, "x"), ("transport", None, "y")], [("server", None, "x")]]
    rows = L.classify(chains(spark, *yes, *no)).orderBy("id").collect()
    assert [r["retryable"] for r in rows] == [True] * len(yes) + [False] * len(no)
    assert [r["server_error"] for r in rows][4:6] == [True, True] and not rows[0]["server_error"]


def test_messages(spark):
    rows = L.error_message(chains(
        spark, [("a", None, "outer"), ("b", None, "root")], [("a", None, "outer: root"), ("b", None, "root")], [("a", None, None)], [("a", None, None), ("b", None, "root")], [("a", None, "o"), ("b", None, None)], [],
    )).orderBy("id").collect()
    assert [r["error"] for r in rows] == ["outer: root", "outer: root", "a", "a: root", "o", None]


def test_retry_selection(spark):
    rows = [(1, "a", L.RETRY, 1), (2, "a", L.RETRY, 2), (3, "b", L.RETRY, 1), (4, "b", L.ACCEPTED, 2), (5, "c", L.RETRY, 10), (6, "d", L.FAILED, 1)]
    ledger = spark.createDataFrame([(s, "t", u, u, 0, 1, st, n, [], None) for s, u, st, n in rows], L.LEDGER_SCHEMA)
    pending = spark.createDataFrame([(u, i) for i, u in enumerate("aabcde")], "load_id string, x int")
    assert sorted(r["x"] for r in L.retry_select(pending, ledger, 10).collect()) == [0, 1]
    assert L.retry_select(pending, ledger.where(F.lit(False)), 10).isEmpty()
