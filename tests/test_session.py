from __future__ import annotations

from unittest.mock import MagicMock

import os
import subprocess
import sys
from pathlib import Path

import pytest

from roadstream.session import FILE_MANAGER, LOCAL_FILE_MANAGER, PARTITIONS, RUNTIME_SETTINGS, configure, work_folder


def fake(master, **settings):
    spark = MagicMock()
    spark.sparkContext.master = master
    spark.sparkContext.defaultParallelism = 8
    spark.conf.get = lambda name, default=None: settings.get(name, default)
    spark.conf.set = settings.__setitem__
    return spark, settings


@pytest.mark.parametrize(
    ("master", "before", "after"),
    [("local[8]", "200", "8"), ("local[8]", "4", "4"), ("yarn", "200", "200")],
)
def test_partitions(master, before, after):
    spark, settings = fake(master, **{PARTITIONS: before})
    configure(spark)
    assert settings[PARTITIONS] == after
    assert RUNTIME_SETTINGS.items() <= settings.items()


def test_a_chosen_number_of_partitions_stays():
    spark, settings = fake("local[8]", **{PARTITIONS: "200"})
    spark.sparkContext.getConf.return_value.get = {PARTITIONS: "200"}.get
    configure(spark)
    assert settings[PARTITIONS] == "200"
    spark, settings = fake("local-cluster[2,1,1024]", **{PARTITIONS: "200"})
    configure(spark)
    assert settings[PARTITIONS] == "200"


@pytest.mark.parametrize(
    ("folder", "default", "chosen", "after"),
    [
        ("/tmp/x", "file:///", None, LOCAL_FILE_MANAGER),
        ("file:///tmp/x", "file:///", None, LOCAL_FILE_MANAGER),
        (None, "file:///", None, LOCAL_FILE_MANAGER),
        ("/shared/x", "hdfs://a", None, None),
        ("hdfs://a/x", "file:///", None, None),
        ("/tmp/x", "file:///", "mine", "mine"),
    ],
)
def test_checkpoints_on_a_local_disk_need_no_processes(folder, default, chosen, after):
    given = {"spark.checkpoint.dir": folder, FILE_MANAGER: chosen}
    spark, settings = fake("yarn", **{PARTITIONS: "8"}, **{k: v for k, v in given.items() if v})
    spark.sparkContext._jsc.hadoopConfiguration.return_value.get.return_value = default
    configure(spark)
    assert settings.get(FILE_MANAGER) == after


def test_work_folder():
    spark, _ = fake("yarn", **{"spark.checkpoint.dir": "hdfs://shared/x/"})
    assert work_folder(spark, "job").startswith("hdfs://shared/x/job-")
    assert work_folder(spark, "job") != work_folder(spark, "job")


def test_a_cluster_needs_a_shared_folder():
    spark, _ = fake("yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(spark, "job")


def test_a_local_session_makes_its_own_folder():
    spark, settings = fake("local[2]")
    first, second = work_folder(spark, "job"), work_folder(spark, "job")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    # The setting is read-only in a running session.
    assert "spark.checkpoint.dir" not in settings


def test_a_real_session_without_the_setting(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from roadstream.session import configure, work_folder\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "print('FOLDER', work_folder(configure(spark), 'job'))\n"
    )
    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True)
    assert "FOLDER" in done.stdout, done.stderr


def test_several_executors_need_a_shared_folder():
    spark, _ = fake("local-cluster[2,1,1024]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(spark, "job")
