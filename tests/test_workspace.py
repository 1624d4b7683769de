from types import SimpleNamespace

import pytest

from tastegraph import workspace


def _session(shared=None, current=None, master="yarn", app="app-1"):
    context = SimpleNamespace(applicationId=app, master=master, getCheckpointDir=lambda: current)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: shared or default))


def test_shared_folder_comes_first():
    assert workspace.workspace_root(_session("hdfs://x/ckpt/", "hdfs://other")) == "hdfs://x/ckpt/app-1"
    assert workspace.workspace_root(_session(None, "hdfs://x/set-by-hand")) == "hdfs://x/set-by-hand/app-1"
    assert workspace.workspace_root(_session(None, "hdfs://x/set-by-hand/app-1")) == "hdfs://x/set-by-hand/app-1"


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://a:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            workspace.workspace_root(_session(master=master))
    with pytest.raises(RuntimeError):
        workspace.workspace_root(_session("file:///tmp/x"))
    assert workspace.workspace_root(_session("file:///tmp/x", master="local-cluster[2,1,1024]")) == "file:///tmp/x/app-1"


def test_a_job_can_clear_what_it_wrote(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "workspace_root", lambda _: f"{tmp_path}/app")
    table = workspace.materialize(spark.range(3), "numbers")
    assert table.count() == 3 and (tmp_path / "app").exists()
    workspace.clear_workspace(spark)
    assert not (tmp_path / "app").exists()


def test_local_session_gets_one_temporary_folder():
    first = workspace.workspace_root(_session(master="local[2]", app="local-1"))
    assert first == workspace.workspace_root(_session(master="local[2]", app="local-1"))


def test_materialized_table_reads_back(spark):
    table = workspace.materialize(spark.range(5).selectExpr("id", "id * 2 as twice"), "numbers")
    assert table.count() == 5 and table.columns == ["id", "twice"]
    assert table.inputFiles()[0].split("://")[-1].lstrip("/").startswith(
        workspace.workspace_root(spark).split("://")[-1].lstrip("/"))
