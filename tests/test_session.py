from emporia.session import REQUIRED, configure, shared_dir


def test_shared_dir_reads_the_session_setting(spark):
    first = shared_dir(spark)
    again = shared_dir(spark)
    assert first == again and first  # stable, never replaced once set
    assert spark.sparkContext.getCheckpointDir()


def test_configure_forces_only_result_settings(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == REQUIRED["spark.sql.session.timeZone"]
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"  # the cluster's choice wins
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    import pytest

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))
    made = []
    context.master, context.setCheckpointDir = "local[2]", made.append
    assert shared_dir(SimpleNamespace(sparkContext=context)) == made[0]
