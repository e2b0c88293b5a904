from __future__ import annotations

import os

from arrears import session


def test_work_is_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", {})
    paths = [session.fresh_path(spark, f"t{i}") for i in range(2)]
    spark.range(3).write.parquet(paths[0])
    assert os.path.isdir(paths[0])
    assert session.clear_work(spark) == 2 and not os.path.exists(paths[0])
    assert session.clear_work(spark) == 0


def test_settings_of_a_session(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "100m"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
