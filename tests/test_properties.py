"""Random RSVPs against a plain-Python count."""

from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.rsvps import at, frame, rsvp
from turnout import plans

BASE = int(at("2024-01-01 00:00:00").timestamp())
SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
RSVPS = st.lists(
    st.tuples(
        st.integers(0, 119),
        st.integers(1, 8),
        st.sampled_from(["yes", "no", "YES"]),
        st.lists(st.sampled_from("ABCDE"), max_size=3),
    ),
    min_size=1,
    max_size=60,
)


def build(spark, drawn):
    from datetime import datetime, timezone

    return frame(spark, [
        rsvp(datetime.fromtimestamp(BASE + second, timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), member, response=response, topics=topics)
        for second, member, response, topics in drawn
    ])


def by_window(result, key):
    found = defaultdict(list)
    for row in result.collect():
        found[int(row.window_start.timestamp()) - BASE].append((row["position"], row["count"], row[key]))
    return found


def brute_force(pairs, k):
    """Windows of 60 s every 20 s, ranked: (second, key) pairs to {start: [(position, count, key)]}."""
    counts = defaultdict(Counter)
    for second, key in pairs:
        newest = second - second % 20
        for start in (newest, newest - 20, newest - 40):
            counts[start][key] += 1
    ranked = {}
    for start, counter in counts.items():
        cut = sorted(((-n, key) for key, n in counter.items()))[:k]
        levels = sorted({-n for n, _ in cut}, reverse=True)
        ranked[start] = [(levels.index(-n) + 1, -n, key) for n, key in cut]
    return ranked


@SETTINGS
@given(RSVPS)
def test_most_active_members(spark, drawn):
    found = by_window(plans.most_active_members(build(spark, drawn), k=3), "member_id")
    wanted = brute_force([(second, member) for second, member, _, _ in drawn], 3)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}


@SETTINGS
@given(RSVPS)
def test_trending_topics(spark, drawn):
    found = by_window(plans.trending_topics(build(spark, drawn), k=2), "topic")
    wanted = brute_force(
        [(second, topic) for second, _, response, topics in drawn if response == "yes" for topic in topics], 2
    )
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}


@SETTINGS
@given(RSVPS, st.integers(0, 4))
def test_bursts(spark, drawn, threshold):
    result = plans.burst_members(build(spark, drawn), threshold=threshold)
    found = {(int(r.window_start.timestamp()) - BASE, r.member_id): r["count"] for r in result.collect()}
    counts = Counter((second - second % 20, member) for second, member, _, _ in drawn)
    assert found == {key: n for key, n in counts.items() if n > threshold}


@SETTINGS
@given(RSVPS)
def test_order_of_arrival_does_not_matter(spark, drawn):
    results = [
        sorted(map(str, plans.most_active_members(build(spark, rows)).collect()))
        for rows in (drawn, drawn[::-1])
    ]
    assert results[0] == results[1]
