import os
from types import SimpleNamespace

import pytest

from eventfares import settings
from eventfares.settings import clear, keep


def fake(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_shared_folder_is_the_configured_one(spark):
    assert settings.shared_dir(fake("yarn", spark_checkpoint_dir="hdfs:///x")) == "hdfs:///x"
    assert settings.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_a_local_session_gets_a_temporary_folder():
    local = fake("local[2]")
    assert settings.shared_dir(local) == settings.shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        settings.shared_dir(fake("yarn"))


def test_intermediate_folders_are_gone_after_clear(spark):
    rows = keep(spark.range(5), "some")
    path = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    clear(spark)
    assert not os.path.exists(path)


def test_kept_rows_are_read_back(spark):
    df = spark.sql("SELECT 1 AS a, array(named_struct('b', date '2020-02-29')) AS l")
    kept = settings.keep(df, "t")
    assert kept.collect() == df.collect() and kept.schema.simpleString() == df.schema.simpleString()
    assert settings.keep(df.limit(0), "t").count() == 0
