from __future__ import annotations

import json

from pyspark.sql import functions as F

from tests.rsvps import frame, rows, rsvp
from turnout import plans


def starting(df, text):
    return df.where(F.date_format("window_start", "HH:mm:ss") == text)


def test_most_active_members_golden(spark):
    df = frame(
        spark,
        [rsvp("2024-01-01 00:00:01", member=1)] * 3
        + [rsvp("2024-01-01 00:00:05", member=2)] * 2
        + [rsvp("2024-01-01 00:00:19", member=3, response="no")] * 2
        + [rsvp("2024-01-01 00:00:21", member=4)],
    )
    best = plans.most_active_members(df)
    first = starting(best, "23:59:20")
    assert rows(first, "member_id", "member_name", "count", "position", "dateForIndex") == [
        (1, "member 1", 3, 1, "2024.01.01"),
        (2, "member 2", 2, 2, "2024.01.01"),
        (3, "member 3", 2, 2, "2024.01.01"),
    ]
    full = starting(best, "00:00:00")
    assert rows(full, "member_id", "position") == [(1, 1), (2, 2), (3, 2), (4, 3)]
    assert rows(starting(best, "00:00:20"), "member_id", "count", "position") == [(4, 1, 1)]


def test_at_most_k_per_window(spark):
    df = frame(spark, [rsvp(member=i) for i in range(20)])
    assert rows(starting(plans.most_active_members(df), "00:00:00"), "member_id") == [(i,) for i in range(5)]


def test_renamed_member_is_two_groups(spark):
    df = frame(spark, [rsvp(name="Ann"), rsvp(name="Anne"), rsvp(name="Anne")])
    best = starting(plans.most_active_members(df), "00:00:00")
    assert rows(best, "member_id", "member_name", "count") == [(1, "Ann", 1), (1, "Anne", 2)]


def test_repeated_rsvp_counts_again(spark):
    df = frame(spark, [rsvp(rsvp_id=5), rsvp(rsvp_id=5)])
    assert rows(plans.most_active_overall(df), "count", "position") == [(2, 1)]


def test_trending_topics_golden(spark):
    df = frame(
        spark,
        [rsvp(topics=("A", "B")), rsvp(topics=("A", "A")), rsvp(topics=("C",), response="no"), rsvp(topics=("D",))],
    )
    best = starting(plans.trending_topics(df), "00:00:00")
    assert rows(best, "topic", "count", "position", "dateForIndex") == [
        ("A", 3, 1, "2024.01.01"), ("B", 1, 2, "2024.01.01"), ("D", 1, 2, "2024.01.01"),
    ]
    assert rows(plans.trending_overall(df, k=2), "topic", "count", "position") == [("A", 3, 1), ("B", 1, 2)]


def test_ten_topics_per_window(spark):
    df = frame(spark, [rsvp(topics=[f"T{i:02d}" for i in range(15)])])
    best = starting(plans.trending_topics(df), "00:00:00")
    assert rows(best, "topic") == [(f"T{i:02d}",) for i in range(10)]


def test_burst_needs_more_than_the_threshold(spark):
    df = frame(spark, [rsvp(member=1)] * 6 + [rsvp(member=2)] * 7)
    bursts = plans.burst_members(df)
    assert rows(bursts, "member_id", "member_name", "count", "dateForIndex") == [(2, "member 2", 7, "2024.01.01")]


def test_burst_windows_tumble_unless_they_slide(spark):
    times = ["2024-01-01 00:00:18"] * 4 + ["2024-01-01 00:00:22"] * 4
    df = frame(spark, [rsvp(t) for t in times])
    assert plans.burst_members(df).count() == 0
    assert rows(starting(plans.burst_members(df, slide="10 seconds"), "00:00:10"), "count") == [(8,)]


def test_alert_payload(spark):
    df = frame(spark, [rsvp(member=123456789, name="Ann")] * 7)
    alert = plans.alert_payload(plans.burst_members(df)).first()
    assert alert["key"] == "123456789"
    body = json.loads(alert["value"])
    assert list(body) == list(plans.ALERT_FIELDS)
    assert body == {
        "member_name": "Ann",
        "member_id": 123456789,
        "dateForIndex": "2024.01.01",
        "count": 7,
        "title": "User in frenzy detected!",
        "message": "User > 123456789 (Ann) < sent > 7 < rsvps in 20 seconds ! This is shady - please verify !",
    }


def test_slim_alert_payload(spark):
    df = frame(spark, [rsvp()] * 7)
    alert = plans.alert_payload(plans.burst_members(df), columns=plans.SLIM_ALERT_FIELDS).first()
    assert list(json.loads(alert["value"])) == ["title", "message"]


def test_alert_cap_keeps_the_largest(spark):
    bursts = spark.range(1000).selectExpr(
        "timestamp'2024-01-01 00:00:00' AS window_start", "timestamp'2024-01-01 00:00:20' AS window_end",
        "concat('m', id) AS member_name", "id AS member_id", "'2024.01.01' AS dateForIndex",
        "IF(id = 500, 7L, 8L) AS count",
    )
    alerts = plans.alert_payload(bursts, max_alerts=999)
    assert alerts.count() == 999
    assert alerts.where("key = '500'").count() == 0


def test_no_rsvps_no_results(spark):
    df = frame(spark, [rsvp()]).limit(0)
    assert plans.most_active_members(df).count() == 0
    assert plans.alert_payload(plans.burst_members(df)).count() == 0
