from __future__ import annotations

from types import SimpleNamespace

import pytest

from civicflow import session


def fake(master: str, **settings):
    context = SimpleNamespace(applicationId=f"app-{master}-{len(settings)}", master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_the_shared_folder_of_the_session_is_used():
    spark = fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://lake/work/"})
    path = session.scratch_dir(spark, "batch")
    assert path.startswith("hdfs://lake/work/civicflow-app-") and "/batch-" in path
    assert path != session.scratch_dir(spark, "batch")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("yarn"), "batch")


def test_settings_results_depend_on_are_set(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.configure(spark)
    assert {k: spark.conf.get(k) for k in session.RUNTIME_CONF} == session.RUNTIME_CONF
