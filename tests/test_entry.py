"""Driver contract: entry, queries, oracle_sql."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "log_type", "log_count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_only_non_sql_results_lack_an_oracle():
    missing = set(E.queries()) - set(E.oracle_sql())
    assert all(k == "pipeline" or k.startswith("op") for k in missing)


def test_scratch_lives_under_the_sessions_checkpoint_dir(spark):
    from sensorweave.session import ensure_checkpoint_dir, scratch_path
    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace
    import pytest
    from sensorweave.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: conf, master="yarn", getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=sc))


def test_oracle_sql_has_no_signed_zero_round():
    import re
    for key, sql in E.oracle_sql().items():
        for m in re.finditer(r"(?<![\w])round\(", sql):
            assert sql[max(0, m.start() - 1)] == "(", key
