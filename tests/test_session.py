from pitchlake.session import checkpoint_dir, cluster_conf, lake_root


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, total_cores=64)
    big = cluster_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # 2 per core floor
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600         # no upper limit
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def test_lake_root_lives_under_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert base and lake_root(spark, "x").startswith(base.rstrip("/"))


def test_api_names_match_composite_keys():
    import __spark_entry__ as E
    from pitchlake import api
    assert set(api.__all__) <= set(E.queries())
    assert all(callable(getattr(api, n)) for n in api.__all__)
