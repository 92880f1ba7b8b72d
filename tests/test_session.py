from types import SimpleNamespace

import pytest

from tickloom import session


def fake(master, conf=None):
    context = SimpleNamespace(applicationId=f"app-{master}", master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf or d), sparkContext=context)


def test_scratch_is_below_the_shared_folder():
    path = session.scratch_dir(fake("spark://host:7077", "hdfs://shared/ckpt/"), "x")
    assert path.startswith("hdfs://shared/ckpt/app-spark://host:7077/x-")


def test_scratch_without_a_shared_folder_is_below_the_warehouse():
    conf = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}
    context = SimpleNamespace(applicationId="app", master="yarn")
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)
    assert session.scratch_dir(spark, "x").startswith("hdfs://shared/warehouse/scratch/app/x-")


def test_scratch_space_is_deleted(spark):
    with pytest.raises(ZeroDivisionError), session.scratch_space(spark, "x") as path:
        session.stored(spark, spark.range(3), "three", path)
        assert session.path_exists(spark, f"{path}/three")
        1 / 0  # noqa: B018
    assert not session.path_exists(spark, path)


def test_scratch_paths_differ(spark):
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")
    assert session.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_required_settings_leave_the_session_alone(spark):
    assert session.prepare(spark) is spark
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        own = session.prepare(spark)
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_queries_leave_the_session_alone(spark, sf_dir):
    from tickloom.registry import QUERIES

    before = dict(spark.conf.getAll.items())
    QUERIES["stg_prices_dedup"](spark, sf_dir).count()
    assert dict(spark.conf.getAll.items()) == before


def test_shuffles_grow_with_the_input():
    assert session.shuffle_partitions(100 << 40) == 409_600
    assert session.shuffle_partitions(10 << 30) == 40
    assert session.shuffle_partitions(1) == session.shuffle_partitions(0) == 1


def test_swap(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(text)

    put("old", "1")
    put("new", "2")
    session.swap(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "f").read_text() == "2"
    assert [p.name for p in tmp_path.iterdir()] == ["old"]
    with pytest.raises(OSError):
        session.swap(spark, str(tmp_path / "absent"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "f").read_text() == "2"


def test_path_size(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f").write_bytes(b"12345")
    assert session.path_bytes(spark, str(tmp_path)) >= 5
    assert session.path_exists(spark, str(tmp_path / "a")) and not session.path_exists(spark, str(tmp_path / "b"))
