import os
from types import SimpleNamespace

import pytest

from glossarch.plans import scratch


def test_folder_of_the_session_comes_first():
    given = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: {"spark.checkpoint.dir": "file:///shared/x/"}[name]))
    assert scratch.shared_folder(given) == "file:///shared/x"


def test_written(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    assert rows(scratch.written(df, "t")) == rows(df)
    none = scratch.written(df.filter("n > 5"), "t")
    assert none.count() == 0 and none.schema == df.schema


def test_a_cluster_without_a_shared_folder_is_refused():
    none = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    context = SimpleNamespace(getConf=lambda: {}, master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: none))
    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context))
    some = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: True, get=lambda: "hdfs://x/y/"))
    context._jsc = SimpleNamespace(sc=lambda: some)
    assert scratch.shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)) == "hdfs://x/y"


def test_clear(spark):
    scratch.written(spark.range(3), "t")
    path = scratch._tables[-1].removeprefix("file://")
    assert os.path.exists(path) and scratch.clear(spark) >= 1 and not os.path.exists(path) and scratch.clear(spark) == 0
