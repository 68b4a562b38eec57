from wordloom.session import durable, ensure_checkpoint_dir, numbered, spread, stored


def test_spread_only_small_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores * 2)
    assert spread(many) is many
    assert sorted(r.id for r in spread(one).collect()) == list(range(100))


def test_durable_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(50).selectExpr("id", "id * 2 AS y")
    out = durable(df)
    assert sorted(out.collect()) == sorted(df.collect())
    plan = out._jdf.queryExecution().logical().toString()
    assert "Range" not in plan  # read back from the checkpoint, not recomputed from the source


def test_checkpoint_dir_is_set(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d


def test_stored_and_numbered(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(100, 0, -1)], "k string, v int").repartition(5)
    assert sorted(stored(df).collect()) == sorted(df.collect())
    for per_part in (7, 1000):
        rows = numbered(df, "k", "place", per_part).orderBy("k").collect()
        assert [r.place for r in rows] == list(range(100)) and [r.v for r in rows] == list(range(1, 101))
    assert numbered(df.limit(0), "k").count() == 0
