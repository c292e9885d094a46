import os
from types import SimpleNamespace

import pytest

from chatloom import runtime


def test_scratch_is_removed(spark):
    df = runtime.materialize(spark.range(3).toDF("a"), "t")
    assert df.count() == 3
    root = runtime.local_path(runtime._scratch_root(spark))
    assert os.listdir(root) and runtime.release(spark) >= 1 and os.listdir(root) == [] and runtime.release(spark) == 0
    assert runtime.materialize(spark.range(2).toDF("a"), "t").count() == 2


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_the_shared_folder(master):
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.shared_folder(SimpleNamespace(sparkContext=context, conf=conf))


def test_broadcast_needs_a_proof(spark):
    df = spark.range(3)
    assert runtime.broadcast_if_small(df, 3, 8) is not df and runtime.broadcast_if_small(df, 1 << 30, 8) is df
