from types import SimpleNamespace

import pytest

from brookhouse.llm.scratch import folder


def session(master, root=None):
    settings = {} if root is None else {"spark.checkpoint.dir": root}
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get, set=settings.__setitem__), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="checkpoint"):
        folder(session(master))
    assert folder(session(master, "/shared")).startswith("/shared/")


def test_one_process_may_do_without(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    spark = session("local[2]")
    assert folder(spark).startswith(str(tmp_path)) and folder(spark).rpartition("/")[0] == spark.conf.get("spark.checkpoint.dir")
