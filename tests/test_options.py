import pytest

from trailmark.cli import DEFAULT_OPTIONS, check_options, options, parse_args
from trailmark.sources import read_events


def test_pairs_and_flags():
    assert parse_args(["--outputPath=/r/x y", "--allTime", "--empty="]) == {"outputPath": "/r/x y", "allTime": "true", "empty": ""}


def test_only_prefixed_entries_count():
    assert parse_args(["trigger=1", "-x=2", "--depth=3", "tail", ""]) == {"depth": "3"}


def test_unknown_job_options_are_rejected():
    check_options(options(["--kafkaOption.minPartitions=64", "--errorsSink=console", "--trigger=availableNow"]))
    with pytest.raises(ValueError, match="--inputpath"):
        check_options(options(["--inputpath=/x"]))


def test_split_on_first_equals_and_last_wins():
    m = parse_args(["--a=b=c", "--k=1", "--k=2", "--", "--="])
    assert m["a"] == "b=c"
    assert m["k"] == "2"
    assert "" in m and m[""] == ""  # "--=" is an empty key with empty value
    assert len(m) == 3


def test_defaults_and_override():
    o = options(["--sessionTimeoutMinutes=2", "--source=kafka"])
    assert o["sessionTimeoutMinutes"] == "2"
    assert o["source"] == "kafka"
    assert o["inputPath"] == DEFAULT_OPTIONS["inputPath"] == "./data/events"
    assert o["kafkaTopic"] == "webevents"


def test_unknown_source_is_an_error(spark):
    with pytest.raises(ValueError, match="socket"):
        read_events(spark, "socket")


def test_unknown_source_options_are_errors(spark):
    with pytest.raises(ValueError, match="inputPath"):
        read_events(spark, "files", inputPath="/x")


def test_kafka_options_reach_the_reader(spark, monkeypatch):
    from trailmark.sources import dispatch

    seen = {}
    monkeypatch.setitem(dispatch._READERS, "kafka", lambda spark, **k: seen.update(k))
    read_events(spark, "kafka", topic="t", options={"minPartitions": "8"}, input_path="/ignored")
    assert seen == {"streaming": True, "brokers": "localhost:9092", "topic": "t", "options": {"minPartitions": "8"}}
