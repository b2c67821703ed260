from types import SimpleNamespace

import pytest

from stratalake.session import scratch_dir


def session_with(value, master="local[4]"):
    context = SimpleNamespace(master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: value or default), sparkContext=context)


def test_scratch_is_below_the_folder_the_cluster_names(spark):
    assert scratch_dir(session_with("s3a://shared/work/"), "x").startswith("s3a://shared/work/x-")
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_each_call_names_a_new_folder(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_local_folder_only_where_none_is_named():
    assert "stratalake-" in scratch_dir(session_with(None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_with(None, "spark://host:7077"), "x")
