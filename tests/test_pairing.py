import random

import pytest

from hitloom.operators import pair_edges
from hitloom.operators.pairing import pair_gathered
from tests.conftest import MAPPED, rows

FORMS = {
    "merged": pair_edges,
    "cells": lambda df: pair_edges(df, cell=7),
    "gathered": lambda df: pair_gathered(df.repartition("event_id")),
}


@pytest.fixture(params=FORMS)
def pair(request):
    return FORMS[request.param]


def _frame(spark, edges):
    return spark.createDataFrame([(1, "c", 0, v, e) for v, e in edges], MAPPED)


@pytest.mark.parametrize(
    "edges, expected",
    [
        ([(10, 0)], []),
        ([(10, 1)], []),
        ([(10, 0), (10, 1)], []),
        ([(10, 0), (10, 1), (12, 1)], [(10, 2)]),
        ([(10, 0), (12, 0), (20, 1)], [(10, 10), (12, 8)]),
        ([(10, 0), (10, 0), (20, 1)], [(10, 10)]),
        ([(10, 0), (20, 1), (30, 1)], [(10, 10)]),
        ([(20, 0), (10, 1)], []),
        ([(10, 0), (20, 1), (15, 7), (None, 1), (None, 0)], [(10, 10)]),
        ([(-30, 0), (-20, 1)], [(-30, 10)]),
    ],
)
def test_pairing_rules(spark, pair, edges, expected):
    assert rows(pair(_frame(spark, edges)), "timing", "charge") == expected


def test_null_keys_never_pair(spark, pair):
    df = spark.createDataFrame(
        [(None, "c", 0, 1, 0), (None, "c", 0, 2, 1), (1, None, 0, 1, 0), (1, None, 0, 2, 1)], MAPPED
    )
    assert rows(pair(df)) == []


def test_pairing_equals_brute_force(spark, pair):
    random.seed(3)
    hits = [
        (random.randrange(12), random.choice("ab"), random.randrange(2), random.randrange(-60, 60),
         random.randrange(2))
        for _ in range(1500)
    ]
    expected = set()
    for event, cat, id_, value, edge in hits:
        later = [v - value for e, c, i, v, g in hits
                 if (e, c, i, g) == (event, cat, id_, 1) and v > value]
        if edge == 0 and later:
            expected.add((event, cat, id_, min(later), value))
    got = rows(pair(spark.createDataFrame(hits, MAPPED)))
    assert got == sorted(expected, key=repr)


def test_one_channel_holding_most_hits(spark):
    """A hot channel in every form: the same pulses as counted directly."""
    hits = spark.range(30000).selectExpr(
        "CAST(0 AS BIGINT) AS event_id", "'c' AS cat", "CAST(0 AS BIGINT) AS id",
        "(id * 7919) % 5000 AS value", "id % 2 AS edge",
    )
    values = {0: set(), 1: set()}
    for i in range(30000):
        values[i % 2].add((i * 7919) % 5000)
    ends = sorted(values[1])
    import bisect

    expected = {}
    for v in values[0]:
        k = bisect.bisect_right(ends, v)
        if k < len(ends):
            expected[v] = ends[k] - v
    for form in FORMS.values():
        got = {r["timing"]: r["charge"] for r in form(hits).collect()}
        assert got == expected
