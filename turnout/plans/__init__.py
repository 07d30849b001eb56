"""The analyses, each a function from normalized RSVPs to a result frame."""

from turnout.plans.bursts import ALERT_FIELDS, SLIM_ALERT_FIELDS, alert_payload, burst_members
from turnout.plans.members import member_counts, most_active_members, most_active_overall, rank_members
from turnout.plans.topics import rank_topics, topic_counts, trending_overall, trending_topics

__all__ = [
    "ALERT_FIELDS",
    "SLIM_ALERT_FIELDS",
    "alert_payload",
    "burst_members",
    "member_counts",
    "most_active_members",
    "most_active_overall",
    "rank_members",
    "rank_topics",
    "topic_counts",
    "trending_overall",
    "trending_topics",
]
