import pytest
from pyspark.sql import functions as F

from spindlewatch import names, schemas
from spindlewatch.plans import profile_load
from spindlewatch.operators.monitor import matching_machines
from spindlewatch.plans.profile_load import ProfileStore
from spindlewatch.sources.tables import (
    activity_value,
    key_set,
    note_activities,
    point_lookup,
    read_profiles,
    register_tables,
    write_profiles,
)
from spindlewatch.sources.templates import accepted_templates


def templates(spark, *lines):
    return accepted_templates(spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, line bigint"))


def candidates(spark, *serials):
    rows = [(i, s, "Maker", 150, 8000) for i, s in enumerate(serials)]
    return spark.createDataFrame(rows, "seq bigint, serialNum string, manufacturer string, warningTemp smallint, maxRPM int")


def content(store):
    return sorted((r.serialNum, r.location, r.block) for r in store.read().collect())


def test_load_once(spark, folder):
    store = ProfileStore(spark, folder)
    assert store.status() is None and store.read().count() == 0
    lines = templates(spark, "Reno,A,.9", "Ely,B,0")
    assert store.load_once(candidates(spark, "m0", "m1", "m2", "m1", "m9"), lines, 4) == 4
    assert store.status() == names.LOADER_FINISHED
    # The fourth candidate has the serial number of the second, and replaces it.
    assert content(store) == [("m0", "Reno", "A"), ("m1", "Ely", "B"), ("m2", "Reno", "A")]
    row = point_lookup(store.read(), "serialNum", "m2").collect()[0]
    assert (row.criticalTemp, round(row.faultyOdds, 5)) == (210, 0.9)
    assert [f.dataType for f in store.read().schema] == [f.dataType for f in schemas.MACHINE_PROFILE]
    assert key_set(store.read()).count() == 3

    assert store.load_once(candidates(spark, "x"), lines, 100) is None
    assert len(content(store)) == 3


def test_load_tops_up_what_is_there(spark, folder):
    store = ProfileStore(spark, folder)
    store.replace(spark.createDataFrame([("old", "Ely", "Z", 0.5, "Maker", 100, 160, 8000), ("m0", "Ely", "Z", 0.5, "Maker", 100, 160, 8000)], schemas.MACHINE_PROFILE))
    assert store.load_once(candidates(spark, "m0", "m1", "m2"), templates(spark, "Reno,A,.9"), 4) == 2
    assert content(store) == [("m0", "Reno", "A"), ("m1", "Reno", "A"), ("old", "Ely", "Z")]


def test_enough_machines(spark, folder):
    store = ProfileStore(spark, folder)
    store.replace(spark.createDataFrame([("old", "Ely", "Z", 0.5, "Maker", 100, 160, 8000)], schemas.MACHINE_PROFILE))
    assert store.load_once(candidates(spark, "m0"), templates(spark), 1) == 0
    assert content(store) == [("old", "Ely", "Z")] and store.status() == names.LOADER_FINISHED


def test_failed_load_can_be_run_again(spark, folder):
    store = ProfileStore(spark, folder)
    with pytest.raises(ValueError, match="templates"):
        store.load_once(candidates(spark, "m0"), templates(spark, "bad"), 1)
    assert store.status() is None
    with pytest.raises(ValueError, match="at least 1"):
        store.load_once(candidates(spark, "m0"), templates(spark, "Reno,A,.9"), 0)
    with pytest.raises(ValueError, match="between 1 and 3 inclusive"):
        store.load_once(candidates(spark, "m0"), templates(spark, "Reno,A,.9"), 4, most=3)
    assert store.load_once(candidates(spark, "m0"), templates(spark, "Reno,A,.9"), 1) == 1


def test_ledger_keeps_the_newest_value(spark, folder):
    path = f"{folder}/ledger"
    assert activity_value(spark, path, "k") is None
    note_activities(spark, path, {"k": "STARTED"})
    note_activities(spark, path, {"k": names.LOADER_FINISHED, "j": "1"})
    note_activities(spark, path, {"other": "x"})
    assert activity_value(spark, path, "k") == names.LOADER_FINISHED
    assert activity_value(spark, path, "j") == "1"


@pytest.mark.parametrize("fails_in", ["write_profiles", "note_activities"])
@pytest.mark.parametrize("after", [False, True])
def test_a_load_that_died_is_as_if_it_had_not_begun(spark, folder, monkeypatch, fails_in, after):
    """Candidates with duplicates, a crash before or after each write, and a second run."""
    plain = getattr(profile_load, fails_in)
    lines, crashes = templates(spark, "Reno,A,.9", "Ely,B,0", "Ely,C,0"), [1]

    def crash(*args):
        if after:
            plain(*args)
        if crashes.pop():
            raise RuntimeError("lost")

    store = ProfileStore(spark, folder)
    monkeypatch.setattr(profile_load, fails_in, crash)
    with pytest.raises(RuntimeError):
        store.load_once(candidates(spark, "A", "B", "A"), lines, 3)
    monkeypatch.undo()
    store.load_once(candidates(spark, "A", "B", "A"), lines, 3)
    assert content(store) == [("A", "Ely", "C"), ("B", "Ely", "B")]
    assert store.status() == names.LOADER_FINISHED


def test_of_two_loaders_at_once_one_loads(spark, folder, monkeypatch):
    """The second one begins while the first is at work."""
    store, other, lines = ProfileStore(spark, folder), ProfileStore(spark, folder), templates(spark, "Reno,A,.9")
    plain, seen = profile_load.write_profiles, []

    def interleaved(profiles, path):
        plain(profiles, path)
        with pytest.raises(profile_load.LoadInProgress):
            other.load_once(candidates(spark, "B"), lines, 1)
        seen.append(1)

    monkeypatch.setattr(profile_load, "write_profiles", interleaved)
    assert store.load_once(candidates(spark, "A"), lines, 1) == 1
    monkeypatch.undo()
    assert seen == [1] and content(store) == content(other) == [("A", "Reno", "A")]
    assert other.load_once(candidates(spark, "B"), lines, 1) is None


def test_a_loader_taken_for_dead_does_no_harm_when_it_comes_back(spark, folder, monkeypatch):
    store, other, lines = ProfileStore(spark, folder), ProfileStore(spark, folder), templates(spark, "Reno,A,.9")
    plain, done = profile_load.write_profiles, []

    def slow(profiles, path):
        if not done:
            # The lease of the first has run out; another one takes over and finishes.
            done.append(1)
            assert other.load_once(candidates(spark, "B"), lines, 1) == 1
        plain(profiles, path)

    monkeypatch.setattr(profile_load, "write_profiles", slow)
    with pytest.raises(profile_load.LoadInProgress, match="in the meantime"):
        store.load_once(candidates(spark, "A"), lines, 1, lease=0)
    assert content(store) == [("B", "Reno", "A")]
    assert store.load_once(candidates(spark, "A"), lines, 1) is None


def test_versions_are_told_by_number_and_a_failed_load_leaves_no_claim(spark, folder, monkeypatch):
    store = ProfileStore(spark, folder)
    rows = lambda name: spark.createDataFrame([(name, "Ely", "Z", 0.5, "Maker", 100, 160, 8000)], schemas.MACHINE_PROFILE)
    for name in "ab":
        store.replace(rows(name))
    assert content(store) == [("b", "Ely", "Z")]
    with pytest.raises(ValueError, match="templates"):
        store.load_once(candidates(spark, "m0"), templates(spark, "bad"), 2)
    assert store.load_once(candidates(spark, "m0"), templates(spark, "Reno,A,.9"), 2) == 1
    # A clock that goes back changes nothing.
    store.replace(rows("c"))
    assert content(store) == [("c", "Ely", "Z")] and store.load_once(candidates(spark, "x"), templates(spark), 9) is None


def rows_read(df):
    """Rows that come out of the scans of a plan, which leave out row groups before they are read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]


def test_a_lookup_reads_one_row_group(spark, folder):
    many = spark.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("serialNum"), F.lit("Reno").alias("location"), F.lit("A").alias("block"),
        F.lit(0.1).cast("float").alias("faultyOdds"), F.sha2(F.col("id").cast("string"), 512).alias("manufacturer"),
        F.lit(1).cast("smallint").alias("warningTemp"), F.lit(2).cast("smallint").alias("criticalTemp"), F.lit(3).alias("maxRPM"),
    )
    write_profiles(many, f"{folder}/p", row_group_bytes=1024 * 1024)
    stored = read_profiles(spark, f"{folder}/p")
    serial = many.where("id = 4321") if "id" in many.columns else many.limit(1)
    name = serial.first().serialNum
    (read,) = rows_read(point_lookup(stored, "serialNum", name))
    assert 0 < read < 30_000
    # By its range a row group might hold this one, by its Bloom filter none does.
    (read,) = rows_read(point_lookup(stored, "serialNum", name[:-1] + ("0" if name[-1] != "0" else "1")))
    assert read < 30_000


def test_profiles_are_stored_by_location(spark, folder, capsys):
    places = ["place 0", "place 1", "", None, "=", "a/b=c"]
    rows = [(f"m{i}", places[i % 6], "A", 0.1, "Maker", 100, 160, 8000) for i in range(600)]
    path = f"{folder}/profiles"
    write_profiles(spark.createDataFrame(rows, schemas.MACHINE_PROFILE), path)
    table = read_profiles(spark, path)
    assert table.columns == schemas.MACHINE_PROFILE.names
    chosen = matching_machines(table, "place 1", "A")
    assert chosen.count() == 100
    files = spark.read.schema(schemas.MACHINE_PROFILE).parquet(path).select(F.input_file_name()).distinct().count()
    assert files == 6  # one per location
    assert {r.location: r["count"] for r in table.groupBy("location").count().collect()} == dict.fromkeys(places, 100)
    chosen.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(place" in plan and "PushedFilters: [IsNotNull(block), EqualTo(block,A)]" in plan


def test_tables_have_sql_names(spark, folder):
    store = ProfileStore(spark, folder)
    status = spark.createDataFrame([("m0", 5, 1000)], schemas.MACHINE_STATUS)
    register_tables(spark, profiles=store.read(), status=status)
    assert spark.sql("select * from machine_profiles").columns == schemas.MACHINE_PROFILE.names
    assert spark.sql("select averageBitTemp10s from machine_status").collect()[0][0] == 5
