"""Projections, windowed counts and ranking: the relational steps the jobs are made of."""

from turnout.operators.differences import (
    covered_counts,
    covering_panes,
    crowded_moments,
    pane_levels,
    sliding_counts,
)
from turnout.operators.frequent import frequent_top_k, summaries
from turnout.operators.project import explode_topics, flatten, members, topic_arrays, yes_responses
from turnout.operators.rank import numbered, top_k, with_position
from turnout.operators.windows import windowed_counts

__all__ = [
    "covered_counts",
    "covering_panes",
    "crowded_moments",
    "explode_topics",
    "flatten",
    "frequent_top_k",
    "members",
    "numbered",
    "pane_levels",
    "sliding_counts",
    "summaries",
    "top_k",
    "topic_arrays",
    "windowed_counts",
    "with_position",
    "yes_responses",
]
