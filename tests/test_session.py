from types import SimpleNamespace

import pytest

from flightlane import session


def fake(master, setting=None, context_setting=None, folder=None):
    settings = {"spark.checkpoint.dir": setting}
    context = SimpleNamespace(
        master=master, getConf=lambda: {"spark.checkpoint.dir": context_setting}, getCheckpointDir=lambda: folder)
    conf = SimpleNamespace(get=lambda name, default: settings[name] or default, set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=context), settings


@pytest.mark.parametrize("named", [dict(setting="s3a://x/"), dict(context_setting="s3a://x"), dict(folder="s3a://x")])
def test_the_cluster_names_the_folder(named):
    assert session.shared_folder(fake("spark://m", **named)[0]) == "s3a://x"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        session.shared_folder(fake("spark://m")[0])


def test_a_local_session_gets_one_folder():
    spark, settings = fake("local[2]")
    folder = session.shared_folder(spark)
    assert settings["spark.checkpoint.dir"] == folder and session.shared_folder(spark) == folder
    assert session.new_path(spark, "a") != session.new_path(spark, "a")


def test_stored_rows_are_computed_once(spark):
    rows = spark.range(100).selectExpr("id", "uuid() as tag")
    kept = session.stored(rows, "kept")
    assert kept.collect() == kept.collect() and kept.schema.names == ["id", "tag"]
