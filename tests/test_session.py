import pytest

from spindlewatch.session import STATE_PARTITIONS, partitions_for, run_dir, session_conf, shared_dir, stream_conf

SHUFFLE = "spark.sql.shuffle.partitions"


def test_conf_is_put_back_even_after_an_error(spark):
    before = spark.conf.get(SHUFFLE)
    with pytest.raises(KeyError), session_conf(spark, {SHUFFLE: "77", "spark.spindlewatch.test": "x"}):
        assert spark.conf.get(SHUFFLE) == "77" and spark.conf.get("spark.spindlewatch.test") == "x"
        raise KeyError
    assert spark.conf.get(SHUFFLE) == before
    assert spark.conf.get("spark.spindlewatch.test", None) is None


def test_runs_get_folders_of_their_own_in_the_shared_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = run_dir(spark, "x"), run_dir(spark, "x")
    assert first != second and first.startswith(shared_dir(spark) + "/x-")


def test_only_a_local_session_may_go_without_a_shared_folder(spark, folder):
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    Conf.get = lambda self, key, *default: f"file:{folder}" if "warehouse" in key else dict.get(self, key, *default)

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
    Cluster.sparkContext.master = "local[2]"
    assert shared_dir(Cluster()) == Cluster.conf["spark.checkpoint.dir"]
    assert shared_dir(Cluster()).startswith(f"{folder}/shared-")


def test_state_partitions(spark):
    assert stream_conf(spark, 5)[SHUFFLE] == "5"
    assert stream_conf(spark)[SHUFFLE] == spark.conf.get(STATE_PARTITIONS) == "2"
    before = spark.conf.get(STATE_PARTITIONS)
    spark.conf.unset(STATE_PARTITIONS)
    try:
        assert stream_conf(spark)[SHUFFLE] == str(spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set(STATE_PARTITIONS, before)


def test_partitions_grow_with_the_shuffle():
    assert partitions_for(0) == partitions_for(1 << 30) == 200
    assert partitions_for(10 << 40) == 81_920
