"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from ballotlake.llm.shared import shared_dir


def session(master, conf):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(
        get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__))


def test_shared_dir():
    assert shared_dir(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///tmp/x/"})) == "hdfs:///tmp/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn", {}))
    conf = {}
    assert shared_dir(session("local[4]", conf)) == conf["spark.checkpoint.dir"]
