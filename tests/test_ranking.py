"""Ranks of large groups equal those of a plain sort, however the groups are cut."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from fixtures import events
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clienttrail.operators.ranking import with_event_rank


def order_key(row):
    return (row.event_date, row.record_id is not None, row.record_id or 0)


def assert_ranked(df, ranked):
    """Every row once per copy, ranks 1..n per group and in order of date and record."""
    columns = df.columns
    assert ranked.columns == [*columns, "event_rank"]
    result = ranked.collect()
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r)[:-1] for r in result)
    groups = defaultdict(list)
    for r in result:
        groups[r.client_id, r.event_type].append(r)
    for group in groups.values():
        group.sort(key=lambda r: r.event_rank)
        assert [r.event_rank for r in group] == list(range(1, len(group) + 1))
        keys = [order_key(r) for r in group]
        assert keys == sorted(keys)


def skewed(spark, n=600, seed=1):
    """Two thirds of the rows belong to one client, with ties, copies and null keys."""
    rng = random.Random(seed)
    records = []
    for i in range(n):
        hot = rng.random() < 0.66
        records.append(
            dict(
                record_id=rng.choice([None, i, rng.randrange(50)]),
                client_id=7 if hot else rng.choice([None, *range(20)]),
                event_type="applied" if hot else rng.choice(["applied", "signed", None]),
                event_date=f"2023-01-{rng.randrange(1, 6):02d}",
                plan=rng.choice(["Pro", "Basic"]),
            )
        )
    return events(spark, *records)


@pytest.mark.parametrize(
    ("hot_rows", "slice_rows", "copies"), [(20, 10, 3), (5, 1, 1), (1, 50, 1000), (10**9, 10, 3)]
)
def test_cut_groups_rank_like_whole_ones(spark, hot_rows, slice_rows, copies):
    df = skewed(spark)
    assert_ranked(df, with_event_rank(df, hot_rows, slice_rows, copies))


def test_both_ways_give_the_same_rows(spark):
    """Row by row, also for tied rows, null keys and copies."""
    df = skewed(spark)
    whole = Counter(map(tuple, with_event_rank(df).collect()))
    assert whole == Counter(map(tuple, with_event_rank(df, 5, 3, 2).collect()))


def test_exact_copies(spark):
    one = dict(record_id=5, client_id=1, event_type="applied", event_date="2023-01-01")
    later = {**one, "record_id": 6}
    df = events(spark, *[one] * 100, *[later] * 50, {**one, "client_id": 2})
    ranked = with_event_rank(df, 10, 4, 7)
    assert_ranked(df, ranked)
    assert ranked.where("record_id = 6").agg({"event_rank": "min"}).first()[0] == 101


def test_null_group_is_cut_too(spark):
    records = [
        dict(client_id=None, event_type=None, event_date=f"2023-01-{1 + i % 28:02d}")
        for i in range(120)
    ]
    df = events(spark, *records)
    assert_ranked(df, with_event_rank(df, 10, 5))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, 1, 2]),
            st.sampled_from(["applied", "signed"]),
            st.integers(1, 3),
            st.sampled_from([None, 1, 2, 3, 4]),
        ),
        min_size=1,
        max_size=40,
    ),
    st.integers(1, 8),
    st.integers(1, 8),
)
def test_any_events(spark, records, hot_rows, slice_rows):
    df = events(
        spark,
        *[
            dict(client_id=c, event_type=t, event_date=f"2023-01-0{d}", record_id=r)
            for c, t, d, r in records
        ],
    )
    assert_ranked(df, with_event_rank(df, hot_rows, slice_rows, 2))
