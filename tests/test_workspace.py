from __future__ import annotations

from tokenloom.plans import workspace


def test_named_folder_is_used(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "_SETTING", "spark.test.shared")
    spark.conf.set("spark.test.shared", f"{tmp_path}/")
    try:
        assert workspace.shared_folder(spark) == str(tmp_path)
        stored = workspace.written(spark.range(3), "numbers")
        assert stored.count() == 3 and list(tmp_path.glob("tokenloom/numbers-*/*.parquet"))
        assert workspace.new_path(spark, "x") != workspace.new_path(spark, "x")
    finally:
        spark.conf.unset("spark.test.shared")


def test_local_session_without_a_folder(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_SETTING", "spark.test.unset")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    folder = workspace.shared_folder(spark)
    assert folder == workspace.shared_folder(spark)
    assert workspace.written(spark.range(2), "numbers").count() == 2
