import datetime as dt
import os
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spindlewatch import schemas
from spindlewatch.functions.json_codec import decode_events, encode_events, malformed_events
from spindlewatch.functions.shared import map_with_resource
from spindlewatch.functions.labels import critical_limit, threshold_label, whole_degrees
from spindlewatch.functions.text import (
    comma_fields,
    control_line,
    event_line,
    float_or_null,
    received_line,
    status_line,
)
from spindlewatch.functions.times import from_epoch_ms, to_epoch_ms, utc_timestamp
from spindlewatch.session import session_conf

FULL = (
    '{"serialNum":"UVQ438","eventTime":1713994242415,"bitRPM":10000,"bitTemp":147,'
    '"bitPositionX":0,"bitPositionY":0,"bitPositionZ":0}'
)


def one(df):
    return df.collect()[0][0]


def test_labels_at_the_limits(spark):
    rows = spark.createDataFrame(
        [(150.0, 150, 210), (150.1, 150, 210), (210.0, 150, 210), (210.1, 150, 210), (-5.0, 150, 210)],
        "t double, w smallint, c smallint",
    )
    labels = [r.label for r in rows.select(threshold_label(F.col("t"), F.col("w"), F.col("c")).alias("label")).collect()]
    assert labels == ["green", "orange", "orange", "red", "green"]


@pytest.mark.parametrize("t, w, c", [(1.0, None, None), (1.0, 150, None), (1.0, None, 210), (None, 150, 210)])
def test_no_label_without_limits(spark, t, w, c):
    rows = spark.createDataFrame([(t, w, c)], "t double, w smallint, c smallint")
    assert one(rows.select(threshold_label(F.col("t"), F.col("w"), F.col("c")))) is None


def test_average_is_cut_off_toward_zero(spark):
    rows = spark.createDataFrame([(99.99,), (-1.9,), (147.0,)], "a double")
    assert [r[0] for r in rows.select(whole_degrees(F.col("a"))).collect()] == [99, -1, 147]


def test_critical_limit(spark):
    assert one(spark.range(1).select(critical_limit(F.lit(240).cast("smallint")))) == 300


def test_epoch_ms(spark):
    ms = 1713994242415
    assert one(spark.range(1).select(to_epoch_ms(from_epoch_ms(F.lit(ms))))) == ms


def test_zone_less_time_is_read_as_utc_in_any_zone(spark):
    ntz = F.lit(dt.datetime(2024, 7, 1, 12, 0, 0, 250000).isoformat()).cast("timestamp_ntz")
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        with session_conf(spark, {"spark.sql.session.timeZone": zone}):
            assert one(spark.range(1).select(to_epoch_ms(utc_timestamp(ntz)))) == 1719835200250


@pytest.mark.parametrize(
    "line, fields",
    [
        ("Reno,A,.9", ["Reno", "A", ".9"]),
        ("Reno,B, .1", ["Reno", "B", " .1"]),
        ("Reno,C,.5,", ["Reno", "C", ".5"]),
        ("Reno,C,.5,,,", ["Reno", "C", ".5"]),
        (",A,.5", ["", "A", ".5"]),
        ("Reno,,.5", ["Reno", "", ".5"]),
        ("Reno,F,", ["Reno", "F"]),
    ],
)
def test_comma_fields(spark, line, fields):
    assert one(spark.createDataFrame([(line,)], "v string").select(comma_fields(F.col("v")))) == fields


def test_float_literals(spark):
    good = [" .9", "1f", "2D", "0x1p3", "-1e2", "NaN", "-Infinity", "1. "]
    bad = ["abc", "", " ", "inf", "nan", "infinity", "1,5", "1_0", "Inf"]
    rows = spark.createDataFrame([(v,) for v in good + bad], "v string")
    parsed = {r.v: r.f for r in rows.select("v", float_or_null(F.col("v")).alias("f")).collect()}
    assert [v for v, f in parsed.items() if f is not None] == good
    assert parsed["0x1p3"] == 8.0 and parsed["2D"] == 2.0


def test_log_texts(spark):
    event = spark.createDataFrame([("S1", 5, 10000, 147, 1, 2, 3)], schemas.MACHINE_EVENT)
    assert one(event.select(event_line())) == (
        "MachineEvent{serialNum='S1', timestamp=5, bitRPM=10000, bitTemp=147, "
        "bitPositionX=1, bitBitPositionY=2, bitPositionZ=3}"
    )
    status = spark.createDataFrame([("S1", 99, 10000)], schemas.MACHINE_STATUS)
    assert one(status.select(status_line())) == (
        "MachineStatus{serialNumber='S1', averageBitTemp10s=99, eventTime=10000}"
    )
    controls = spark.createDataFrame([("S1", "red"), ("S1", "green"), ("S1", "orange")], schemas.CONTROL_MESSAGE)
    assert [r[0] for r in controls.select(control_line(F.col("key"), F.col("value"))).collect()] == [
        "S1 went RED, reducing speed",
        "S1 went GREEN, resuming normal speed",
        None,
    ]
    assert one(controls.select(received_line(F.col("key")))) == "Received event for S1"


# (value, bitTemp when missing numbers are null, malformed)
DECODED = [
    (FULL, 147, False),
    ('{"serialNum":"miss"}', None, False),
    ('{"serialNum":"nul","bitTemp":null}', None, False),
    ('{"serialNum":"unk","zzz":1,"bitTemp":5}', 5, False),
    ('{"serialNum":"ovf","bitTemp":40000}', None, True),
    ('{"serialNum":"str","bitTemp":"147"}', None, True),
    ('{"serialNum":"flt","bitTemp":1.5}', None, True),
    ('{"bitTemp":5}', None, True),
    ("garbage", None, True),
    ("", None, True),
    (None, None, True),
]


def message(spark, *values):
    when = dt.datetime(2024, 4, 24, 21, 30, 42, 415000)
    return spark.createDataFrame([("k", v, when) for v in values], schemas.MESSAGE)


@pytest.mark.parametrize("value, temperature, malformed", DECODED)
def test_decode(spark, value, temperature, malformed):
    messages = message(spark, value)
    good = decode_events(messages, "quarantine", "null").collect()
    bad = malformed_events(messages).collect()
    assert (len(good), len(bad)) == ((0, 1) if malformed else (1, 0))
    if malformed:
        assert bad[0].value == value
        with pytest.raises(PySparkException, match="malformed event"):
            decode_events(messages).select("bitRPM").collect()
    else:
        assert good[0].bitTemp == temperature
        assert decode_events(messages).collect()[0].bitTemp == (temperature or 0)


def test_every_field_is_decoded(spark):
    row = decode_events(message(spark, FULL)).collect()[0]
    assert row[2:] == ("UVQ438", 1713994242415, 10000, 147, 0, 0, 0)
    assert row.key == "k"


def test_decode_refuses_unknown_modes(spark):
    with pytest.raises(ValueError):
        decode_events(message(spark, FULL), on_malformed="ignore")
    with pytest.raises(ValueError):
        decode_events(message(spark, FULL), missing="one")


def test_encode(spark):
    events = spark.createDataFrame([("UVQ438", 1713994242415, 10000, 147, 0, 0, 0)], schemas.MACHINE_EVENT)
    row = encode_events(events).select("key", "value", F.unix_millis("timestamp").alias("ms")).collect()[0]
    assert tuple(row) == ("UVQ438", FULL, 1713994242415)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(min_size=1, alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"])),
            st.integers(-(2**62), 2**62),
            st.integers(-(2**31), 2**31 - 1),
            st.integers(-(2**15), 2**15 - 1),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_decode_undoes_encode(spark, rows):
    full = [(s, e % 4_000_000_000_000, r, t, r, 0, t) for s, e, r, t in rows]
    events = spark.createDataFrame(full, schemas.MACHINE_EVENT)
    back = decode_events(encode_events(events)).select(*events.columns).collect()
    assert sorted(map(tuple, back)) == sorted(full)


def test_shared_resource_is_opened_once_per_task_and_closed(spark, folder):
    class Counter:
        def __init__(self):
            self.seen = 0

        def close(self):
            open(f"{folder}/{uuid.uuid4().hex}-{self.seen}", "w").close()

    def number(counter, frame):
        counter.seen += len(frame)
        return frame.assign(seen=counter.seen)

    rows = spark.range(0, 100, 1, 4)
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "10"}):
        out = map_with_resource(rows, Counter, number, "id bigint, seen bigint").collect()
    assert len(out) == 100 and max(r.seen for r in out) == 25
    assert sorted(f.split("-")[1] for f in os.listdir(folder)) == ["25"] * 4
