"""Shared-folder helpers: the checkpoint folder comes from the session."""

from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir, materialize, materialize_counted, scratch_path


def test_checkpoint_folder_comes_from_session_conf(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark).startswith("file:" + configured) or \
        checkpoint_dir(spark).startswith(configured)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark).rstrip("/"))


def test_materialize_cuts_lineage_and_counts(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    m = materialize(df, "t")
    files = m.inputFiles()            # the plan now starts at the written files
    assert files and all(checkpoint_dir(spark).split(":", 1)[-1] in f for f in files)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    m2, n = materialize_counted(df.where(F.col("k") < 3), "t")
    assert n == 3 == m2.count()
    empty, n0 = materialize_counted(df.where(F.col("k") > 100), "t")
    assert n0 == 0 and empty.count() == 0


def test_scope_removes_what_was_written(spark):
    import os

    from kestrel.operators import graph
    from kestrel.session import checkpoint_dir, materialize, table_scope
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    e = spark.createDataFrame([(0, 1), (1, 2)], "src long, dst long")
    with table_scope(spark) as paths:
        assert graph.hop_distances(e, 0).count() == 3
        with table_scope(spark) as inner:
            materialize(spark.range(3), "inner")
        assert len(inner) == 1 and len(paths) >= 3 and not os.path.exists(inner[0].removeprefix("file:"))
    assert set(os.listdir(base)) == before
    try:
        with table_scope(spark):
            materialize(spark.range(3), "lost")
            raise KeyError
    except KeyError:
        pass
    assert set(os.listdir(base)) == before
    materialize(spark.range(3), "kept")
    assert len(set(os.listdir(base)) - before) == 1
