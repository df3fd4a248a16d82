import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spindlewatch import schemas
from spindlewatch.operators.changes import label_changes
from spindlewatch.operators.controls import actionable, routed, to_messages, with_action
from spindlewatch.operators.latest import latest_per_key, latest_status
from spindlewatch.operators.lookup import unmatched_keys, with_faulty_odds, with_limits
from spindlewatch.operators.monitor import (
    accumulate,
    match_count,
    matching_machines,
    monitor_rows,
    status_of,
)
from spindlewatch.operators.numbering import dense_index, nth_smallest
from spindlewatch.operators.refdata import (
    check_machine_count,
    last_per_key,
    put_rows,
    round_robin,
    top_up,
)
from spindlewatch.operators.windows import status_rows, tumbling_average
from spindlewatch.plans.temperature_monitor import MonitorOptions, label_averages, monitored_changes
from spindlewatch.sources.templates import accepted_templates, read_lines, rejected_lines


def tuples(df):
    return sorted(map(tuple, df.collect()))


def events(spark, rows):
    """(serial, ms, temperature) rows."""
    df = spark.createDataFrame(rows, "serialNum string, ms bigint, bitTemp smallint")
    return df.withColumn("timestamp", F.timestamp_millis("ms"))


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MACHINE_PROFILE)


def profile(serial, location="Reno", block="A", odds=0.5, warning=150):
    return (serial, location, block, odds, "Maker", warning, warning + 60, 8000)


# ---- averages ----


def test_window_edges(spark):
    df = tumbling_average(events(spark, [("A", 1713994242415, 147), ("B", 9999, 1), ("B", 10000, 3), ("B", 0, 2)]))
    assert tuples(df) == [("A", 1713994250000, 147.0), ("B", 10000, 1.5), ("B", 20000, 3.0)]


def test_windows_before_the_epoch(spark):
    assert tuples(tumbling_average(events(spark, [("A", -1, 4), ("A", -10000, 6)]))) == [("A", 0, 5.0)]


def test_zone_less_times_give_the_same_windows(spark):
    df = events(spark, [("A", 9999, 1), ("A", 10000, 3)])
    ntz = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert tuples(tumbling_average(ntz)) == tuples(tumbling_average(df))


def test_other_widths_keys_and_values(spark):
    df = events(spark, [("A", 0, 1), ("A", 59_000, 2)]).withColumnRenamed("serialNum", "m")
    assert tuples(tumbling_average(df, "1 minute", key="m")) == [("A", 60_000, 1.5)]


def test_average_does_not_skip_zeros_but_skips_nulls(spark):
    assert tuples(tumbling_average(events(spark, [("A", 0, 0), ("A", 1, None), ("A", 2, 3)]))) == [("A", 10000, 1.5)]


def test_hot_machine_is_reduced_before_the_shuffle(spark, capsys):
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("serialNum"),
        F.timestamp_millis(F.col("id")).alias("timestamp"),
        (F.col("id") % 100).cast("smallint").alias("bitTemp"),
    )
    tumbling_average(df).explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_avg") > plan.index("Exchange")  # plans print from the result down
    total = tumbling_average(df).where("serialNum = 'hot'").agg(F.count("*")).collect()[0][0]
    assert total == 3


def test_status_rows(spark):
    averages = spark.createDataFrame([("A", 10000, 99.99)], schemas.machine_average())
    out = status_rows(averages)
    assert tuples(out) == [("A", 99, 10000)] and out.schema.names == schemas.MACHINE_STATUS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.MACHINE_STATUS]


def test_latest_status(spark):
    rows = [("A", 1, 10), ("A", 2, 30), ("A", 3, 20), ("B", 4, 10), ("B", 4, 10)]
    df = spark.createDataFrame(rows, schemas.MACHINE_STATUS)
    assert tuples(latest_status(df)) == [("A", 2, 30), ("B", 4, 10)]


def test_latest_keeps_all_columns_in_order(spark):
    df = spark.createDataFrame([("x", "A", 1, None), ("y", "A", 2, None)], "v string, k string, o int, n string")
    assert tuples(latest_per_key(df, "k", "o")) == [("y", "A", 2, None)]


# ---- changes ----


def brute_changes(rows, initial=""):
    out, last = [], {}
    for key, order, label in sorted(rows, key=lambda r: r[:2]):
        if label is not None and last.get(key, initial) != label:
            out.append((key, order, label))
            last[key] = label
    return out


@settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("AB"), st.integers(-40, 40)), st.sampled_from(["green", "orange", "red", None]), min_size=1
    ),
    st.sampled_from([1, 3, 7, 1000, None]),
)
def test_changes_whatever_the_slices(spark, labels, span):
    rows = [(key, order, label) for (key, order), label in labels.items()]
    df = spark.createDataFrame(rows, "serialNum string, windowEnd bigint, label string")
    assert tuples(label_changes(df, slice_span=span)) == brute_changes(rows)


def test_changes_of_a_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot", i, rng.choice(["green", "red"])) for i in range(4000)]
    rows += [(f"m{i % 40}", i, rng.choice(["green", "red"])) for i in range(8000)]
    df = spark.createDataFrame(rows, "serialNum string, windowEnd bigint, label string")
    assert tuples(label_changes(df, slice_span=100)) == brute_changes(rows)


def test_first_label_passes_unless_it_is_the_initial_one(spark):
    df = spark.createDataFrame([("A", 1, "green")], "serialNum string, windowEnd bigint, label string")
    assert label_changes(df).count() == 1
    assert label_changes(df, initial="green").count() == 0


def test_changes_sort_the_histories_once(spark, capsys):
    df = spark.range(1000).selectExpr("id % 9 as serialNum", "id as windowEnd", "string(id % 3) as label")
    label_changes(df, slice_span=50).explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan") + plan.count("Range") == 1 and plan.count("Exchange") == 2


# ---- look-ups ----


def averages(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.machine_average())


def test_limits(spark):
    out = with_limits(averages(spark, ("A", 10, 1.0)), profiles(spark, profile("A"), profile("Z")))
    assert tuples(out) == [("A", 10, 1.0, 150, 210)]


def test_missing_limits_never_read_as_green(spark):
    rows = averages(spark, ("A", 10, 1.0), ("B", 10, 1.0))
    table = profiles(spark, profile("A"))
    with pytest.raises(PySparkException, match="no limits for machine B"):
        label_averages(rows, table).select("windowEnd").collect()
    assert [r.serialNum for r in label_averages(rows, table, "drop").collect()] == ["A"]
    unknown = label_averages(rows, table, "unknown").select("serialNum", "label")
    assert tuples(unknown) == [("A", "green"), ("B", "unknown")]
    assert tuples(with_limits(rows, table, "keep"))[1][3:] == (None, None)
    with pytest.raises(ValueError):
        with_limits(rows, table, "green")


def test_null_limits_are_missing_limits(spark):
    rows = averages(spark, ("A", 10, 1.0))
    table = profiles(spark, ("A", "Reno", "A", 0.5, "Maker", None, None, 8000))
    with pytest.raises(PySparkException, match="no limits"):
        with_limits(rows, table).collect()
    assert with_limits(rows, table, "drop").count() == 0


def test_default_odds(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "serialNum string")
    out = with_faulty_odds(rows, profiles(spark, profile("A", odds=0.9)))
    assert {r.serialNum: round(r.faultyOdds, 5) for r in out.collect()} == {"A": 0.9, "B": 0.1}


def test_unmatched_keys(spark):
    rows = spark.createDataFrame([("A",), ("B",), ("B",)], "serialNum string")
    assert tuples(unmatched_keys(rows, profiles(spark, profile("A")))) == [("B", 2)]


# ---- numbering and reference data ----


@settings(max_examples=6, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1) | st.integers(-300, 300), max_size=60), st.sampled_from([8, 16]))
def test_dense_index(spark, values, bits):
    df = spark.createDataFrame([(v,) for v in values], "o bigint")
    assert tuples(dense_index(df, "o", "i", bits=bits)) == [(v, i) for i, v in enumerate(sorted(values))]


def test_machine_count():
    assert check_machine_count("10") == 10 and check_machine_count(10**12) == 10**12
    assert check_machine_count(5, most=5) == 5
    for bad in ("ten", "0", "", "1.5", -3):
        with pytest.raises(ValueError):
            check_machine_count(bad)
    with pytest.raises(ValueError, match="between 1 and 5"):
        check_machine_count(6, most=5)


@settings(max_examples=6, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1) | st.integers(-300, 300), min_size=1, max_size=40), st.data())
def test_nth_smallest(spark, values, data):
    df = spark.createDataFrame([(v,) for v in values], "o bigint")
    n = data.draw(st.integers(1, len(values) + 1))
    expected = sorted(values)[n - 1] if n <= len(values) else None
    assert nth_smallest(df, "o", n, bits=data.draw(st.sampled_from([2, 16]))) == expected


def test_top_up_reads_up_to_the_last_candidate(spark, folder, capsys):
    spark.range(1000).selectExpr("id as seq").write.parquet(f"{folder}/candidates")
    top_up(spark.read.parquet(f"{folder}/candidates"), 5, 305).explain()
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(seq,299)" in plan and "Exchange" not in plan


@pytest.mark.parametrize("existing, target, chosen", [(0, 3, 3), (2, 3, 1), (3, 3, 0), (5, 3, 0), (0, 99, 6)])
def test_top_up(spark, existing, target, chosen):
    df = spark.createDataFrame([(s, f"m{s}") for s in (50, 10, 30, 20, 60, 40)], "seq bigint, serialNum string")
    assert [r.seq for r in top_up(df, existing, target).orderBy("seq").collect()] == [10, 20, 30, 40, 50, 60][:chosen]


def templates(spark, *lines):
    return accepted_templates(spark.createDataFrame([(v, 10 * i) for i, v in enumerate(lines)], "value string, line bigint"))


def test_round_robin(spark):
    candidates = spark.createDataFrame([(s, f"m{s}") for s in range(5)], "seq bigint, serialNum string")
    out = round_robin(candidates, templates(spark, "Reno,A,.9", "bad", "Reno,B,0", "Ely,A,.1"))
    assert [(r.seq, r.location, r.block) for r in out.orderBy("seq").collect()] == [
        (0, "Reno", "A"), (1, "Reno", "B"), (2, "Ely", "A"), (3, "Reno", "A"), (4, "Reno", "B"),
    ]
    with pytest.raises(ValueError):
        round_robin(candidates, templates(spark, "bad"))


def test_round_robin_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("spindlewatch.operators.refdata.BROADCAST_ROWS", 0)
    candidates = spark.createDataFrame([(s,) for s in range(20)], "seq bigint")
    out = round_robin(candidates, templates(spark, "Reno,A,.9", "Ely,B,0"))
    assert [r.location for r in out.orderBy("seq").collect()] == ["Reno", "Ely"] * 10


def test_last_per_key(spark):
    rows = spark.createDataFrame([("A", 1, "x"), ("A", 3, None), ("A", 2, "z"), ("B", 1, "b")], "serialNum string, seq int, v string")
    assert sorted(map(tuple, last_per_key(rows).collect())) == [("A", 3, None), ("B", 1, "b")]


def test_put_rows(spark):
    table = spark.createDataFrame([("A", 1), ("B", 1)], "serialNum string, v int")
    new = spark.createDataFrame([("B", 2, 0), ("C", 2, 1), ("C", 3, 2)], "serialNum string, v int, seq int")
    assert tuples(put_rows(table, new)) == [("A", 1), ("B", 2), ("C", 3)]


LINES = ["Reno,A,.9", "Reno,B, .1", "Reno,C,.5,", "", "Reno,D", "Reno,D,.1,x", "Reno,E,abc", "Reno,F,", ",,", "Reno,G,inf"]


def test_lines_of_several_files_are_in_the_order_of_the_files(spark, folder):
    texts = {"a.csv": ["first", ""], "b.csv": [f"line {i}" for i in range(5000)], "c.csv": ["last"]}
    for name, lines in texts.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        found = [tuple(r) for r in read_lines(spark, folder).orderBy("line").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(value, i) for i, value in enumerate(line for lines in texts.values() for line in lines)]


def test_template_lines(spark, folder):
    with open(f"{folder}/lines.csv", "w") as f:
        f.write("\n".join(LINES) + "\n")
    lines = read_lines(spark, f"{folder}/lines.csv")
    accepted = accepted_templates(lines).orderBy("line").collect()
    assert [(r.location, r.block, round(r.faultyFraction, 3)) for r in accepted] == [
        ("Reno", "A", 0.9), ("Reno", "B", 0.1), ("Reno", "C", 0.5),
    ]
    rejected = rejected_lines(lines).orderBy("line").collect()
    assert [(r.value, r.reason) for r in rejected] == [
        ("Reno,D", "field count"), ("Reno,D,.1,x", "field count"), ("Reno,E,abc", "number"),
        ("Reno,F,", "field count"), (",,", "field count"), ("Reno,G,inf", "number"),
    ]


# ---- monitor and controls ----


def test_matching_machines(spark):
    table = profiles(spark, profile("A"), profile("B"), profile("C", block="B"), profile("D", location="O'Brien, 'x'"))
    assert tuples(matching_machines(table, "Reno", "A")) == [("A",), ("B",)]
    assert tuples(matching_machines(table, "O'Brien, 'x'", "A")) == [("D",)]
    assert matching_machines(table, "' OR '1'='1", "A").count() == 0
    for place, block in ((None, "A"), ("", "A"), ("Reno", None), ("Reno", "")):
        assert match_count(table, place, block).collect()[0].matches == 0
    assert match_count(table, "Reno", "A").collect()[0].matches == 2


def test_status_of_a_selection(spark):
    status = spark.createDataFrame([("A", 5, 1000), ("A", 6, 2000), ("Z", 7, 1000)], schemas.MACHINE_STATUS)
    table = profiles(spark, profile("A"), profile("B"))
    rows = monitor_rows(status_of(status, matching_machines(table, "Reno", "A")))
    assert rows.schema.names == schemas.MONITOR_ROW.names
    assert [r.average_bit_temp_10s for r in rows.orderBy("event_time").collect()] == [5, 6]
    assert rows.select(F.unix_millis(F.min("event_time"))).collect()[0][0] == 1000
    assert accumulate(rows, rows).count() == 4


def test_controls(spark):
    controls = spark.createDataFrame(
        [("A", "red"), ("A", "orange"), ("B", "green"), ("Z", "red"), ("A", "unknown")], schemas.CONTROL_MESSAGE
    )
    assert tuples(actionable(controls)) == [("A", "red"), ("B", "green"), ("Z", "red")]
    assert {(r.key, r.action) for r in with_action(controls).collect()} == {
        ("A", "reduce speed"), ("B", "resume normal speed"), ("Z", "reduce speed"),
    }
    running = spark.createDataFrame([("A",), ("B",)], "serialNum string")
    out = routed(controls, running, profiles(spark, profile("A", odds=0.5)))
    assert {(r.serialNum, r.value, round(r.faultyOdds, 5)) for r in out.collect()} == {
        ("A", "red", 0.5), ("B", "green", 0.1),
    }


def test_to_messages(spark):
    rows = spark.createDataFrame([(7, "red", dt.datetime(2024, 1, 1))], "serialNum bigint, label string, t timestamp")
    assert to_messages(rows).schema.simpleString() == "struct<key:string,value:string>"
    assert to_messages(rows, timestamp="t").columns == ["key", "value", "timestamp"]


def test_whole_monitor_on_stored_events(spark):
    rows = [("A", s * 1000, t) for s, t in [(1, 100), (9, 100), (13, 400), (25, 401), (36, 90), (47, 160)]]
    options = MonitorOptions(windows_per_slice=2)
    out = monitored_changes(events(spark, rows), profiles(spark, profile("A")), options)
    assert [(r.windowEnd, r.label) for r in out.orderBy("windowEnd").collect()] == [
        (10000, "green"), (20000, "red"), (40000, "green"), (50000, "orange"),
    ]
