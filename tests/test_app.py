from __future__ import annotations

import pytest

from turnout.app import parse
from turnout.streaming import JobConfig

PATHS = dict(input_path="in", output_path="out", checkpoint_path="cp")


def test_defaults():
    cfg = parse(["--input", "in", "--output", "out", "--checkpoint", "cp"])
    assert cfg == JobConfig(**PATHS)
    assert (cfg.length, cfg.slide, cfg.burst_length) == ("60 seconds", "20 seconds", "20 seconds")
    assert (cfg.top_members, cfg.top_topics, cfg.burst_threshold, cfg.max_alerts) == (5, 10, 6, None)
    assert cfg.trigger() == {"processingTime": "20 seconds"}


def test_every_option_reaches_the_config():
    cfg = parse(
        "--input in --input-format kafka --input-option subscribe=rsvps --payload protobuf --output out"
        " --checkpoint cp --window 120 --slide 30 --burst-window 10 --batch 5"
        " --time-column ingest_time --alert-format kafka --alert-option topic=alerts --minutes 2"
        " --available-now --decode-mode FAILFAST --decode-with-jar --burst-slide 5 --threshold 3"
        " --max-alerts 7 --top-members 2 --top-topics 4 --horizon-days 0 --redelivered-within 90".split()
    )
    assert cfg == JobConfig(
        **PATHS, input_format="kafka", input_options={"subscribe": "rsvps"}, payload="protobuf",
        length="120 seconds", slide="30 seconds", burst_length="10 seconds", batch_interval="5 seconds",
        time_col="ingest_time", alert_format="kafka",
        alert_options={"topic": "alerts"}, run_minutes=2, available_now=True,
        decode_mode="FAILFAST", decode_with_jar=True, burst_slide="5 seconds", burst_threshold=3,
        max_alerts=7, top_members=2, top_topics=4, horizon="0 days", redelivered_within="90 seconds",
    )
    assert cfg.trigger() == {"availableNow": True}


def test_paths_are_required():
    with pytest.raises(SystemExit):
        parse(["--input", "in"])


@pytest.mark.parametrize(
    "wrong",
    [
        {"payload": "avro"}, {"time_col": "mtime"}, {"length": "soon"}, {"top_members": 0},
        {"max_alerts": 0}, {"run_minutes": -1}, {"burst_slide": "1 month"},
        {"input_format": "kafka"}, {"horizon": "soon"}, {"redelivered_within": "1 month"},
    ],
)
def test_wrong_parameters_are_rejected(wrong):
    with pytest.raises(ValueError):
        JobConfig(**PATHS, **wrong)


def test_a_queue_needs_no_folder():
    cfg = parse("--input-format kafka --payload json --output out --checkpoint cp".split())
    assert cfg.input_path is None
    with pytest.raises(ValueError):
        parse("--output out --checkpoint cp".split())
