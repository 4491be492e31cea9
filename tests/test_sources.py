import glob
import json
import os

from pyspark.sql import functions as F

from conftest import T0, ev, events_df
from trailmark.operators import click_heatmap, prepare_events, session_paths, user_paths
from trailmark.schema import EVENT_COLUMNS
from trailmark.sources import (
    decode_events,
    encode_events,
    generate_events,
    read_events,
    read_events_files,
    write_events_json,
)

ROWS = [
    ev(timestamp=T0, eventType="click", x=-3, y=4, meta='{"k": 1}'),
    ev(userId=None, timestamp=None, eventType=None, pageUrl=None, element=None, referrer=None,
       screenWidth=None, screenHeight=None, meta=None),
    ev(userId='quote"and\\slash', timestamp=-1, pageUrl="é ü 字"),
]


def test_json_lines_round_trip(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    write_events_json(events_df(spark, ROWS), path)
    for f in glob.glob(f"{path}/*.json"):
        for line in open(f, encoding="utf-8"):
            json.loads(line)  # valid JSON, unlike the reference's sample writer
    back = read_events_files(spark, path, streaming=False)
    assert back.columns == EVENT_COLUMNS
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)


def test_malformed_and_odd_lines(spark, tmp_dir):
    lines = [
        '{"userId":"u1","timestamp":1732000000000,"eventType":view","x":null}',  # sample-writer defect
        "not json",
        "",
        '{"userId":"u"}',
        '{"userId":"a","timestamp":1,"x":12.5}',
        '{"userId":"b","timestamp":1,"x":"12"}',
        '{"userId":"c","timestamp":1,"x":99999999999}',
        '{"userId":"d","timestamp":"1732000000000"}',
        '{"userId":"e","timestamp":2,"extra":1,"meta":{"a": 1}}',
        '[{"userId":"f","timestamp":3},{"userId":"g","timestamp":4}]',
    ]
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    rows = read_events_files(spark, f"{tmp_dir}/in", streaming=False).collect()
    by_user = {r.userId: r for r in rows}
    assert sum(1 for r in rows if all(v is None for v in r)) == 2  # defect line, "not json"; blank skipped
    assert by_user["u"].timestamp is None and by_user["u"].eventType is None
    for u in "abc":
        assert by_user[u].x is None and by_user[u].timestamp == 1  # R14: only the field goes NULL
    assert by_user["d"].timestamp is None
    assert by_user["e"].meta == '{"a": 1}' and by_user["e"].timestamp == 2  # object kept as its text
    assert by_user["f"].timestamp == 3 and by_user["g"].timestamp == 4  # array line: one row each
    # Malformed rows have no event time and vanish from every aggregate
    events = prepare_events(read_events_files(spark, f"{tmp_dir}/in", streaming=False))
    assert session_paths(events, 30).filter(F.col("userId").isNull()).count() == 0


def test_kafka_codec_round_trip_and_keys(spark):
    df = events_df(spark, ROWS)
    enc = encode_events(df)
    assert enc.columns == ["key", "value"]
    keys = [r.key for r in enc.collect()]
    assert bytes(keys[0]) == b"u1" and keys[1] is None
    back = decode_events(enc)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)
    assert all(r.key is None for r in encode_events(df, key_col=None).collect())


def test_meta_object_through_from_json_is_compact_text(spark):
    vals = spark.createDataFrame([(b'{"userId":"e","timestamp":2,"meta":{"a": 1}}',)], "value binary")
    assert decode_events(vals).first().meta == '{"a":1}'


def test_decode_bad_values(spark):
    vals = spark.createDataFrame([(b"not json",), (b"",), (b'[{"userId":"x"}]',), (None,)], "value binary")
    rows = decode_events(vals).collect()
    assert len(rows) == 4
    assert all(all(v is None for v in r) for r in rows)


def test_source_choice(spark, tmp_dir):
    write_events_json(events_df(spark, ROWS[:1]), f"{tmp_dir}/ev")
    df = read_events(spark, "files", streaming=False, input_path=f"{tmp_dir}/ev")
    assert df.count() == 1
    assert read_events(spark, "files", streaming=True, input_path=f"{tmp_dir}/ev").isStreaming


def test_generated_sample_events(spark):
    start = T0 + 60_000  # well inside one 10-minute window
    gen = generate_events(spark, start)
    rows = gen.orderBy("timestamp").collect()
    assert len(rows) == 15
    assert [(r.userId, r.timestamp - (start - 5000), r.eventType) for r in rows[:3]] == [
        ("u1", 0, "view"), ("u1", 50, "click"), ("u2", 100, "view")]
    assert rows[-1].timestamp == start - 5000 + 4 * 500 + 100
    events = prepare_events(gen)
    heat = [(r.pageUrl, r.element, r.xBucket, r.yBucket, r["count"]) for r in click_heatmap(events).collect()]
    assert heat == [("http://localhost/sandbox/page1", "#btn-cta", 300, 400, 5)]
    sess = {r.userId: list(r.path) for r in session_paths(events, 30).collect()}
    assert sess == {"u1": ["http://localhost/sandbox/page1"] * 10, "u2": ["http://localhost/sandbox/page2"] * 5}
    paths = {r.userId: list(r.path) for r in user_paths(events).collect()}
    assert paths == {"u1": ["http://localhost/sandbox/page1"], "u2": ["http://localhost/sandbox/page2"]}
