import os
from types import SimpleNamespace

import pytest

from tidemill.llm import base


def path_of(df):
    return os.path.dirname(df.inputFiles()[0]).removeprefix("file://")


def test_scratch_tables_go_and_kept_ones_stay(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError), base.scratch(spark):
        gone, kept = base.materialize(df, "gone"), base.materialize(df, "kept", keep=True)
        assert gone.count() == kept.count() == 5
        paths = [path_of(x) for x in (gone, kept)]
        raise RuntimeError
    assert [os.path.exists(p) for p in paths] == [False, True]
    assert os.path.exists(path_of(base.materialize(df, "outside")))


def test_no_machine_local_folder_on_a_cluster():
    def session(master, folder=None):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": folder}))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            base.shared_dir(session(master))
        assert base.shared_dir(session(master, "hdfs://x/y/")) == "hdfs://x/y"
    assert base.shared_dir(session("local[4]")).startswith("file://")
