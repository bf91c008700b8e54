from daybar.session import LISTING_PARALLELISM, apply_required_conf, checkpoint_root, scratch_path


def test_required_conf_and_listing_parallelism(spark):
    spark.conf.set(LISTING_PARALLELISM, "10000")  # Spark's default: replaced by the core count
    apply_required_conf(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert int(spark.conf.get(LISTING_PARALLELISM)) == max(8, spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING_PARALLELISM, "123")  # a value the session chose is kept
    apply_required_conf(spark)
    assert spark.conf.get(LISTING_PARALLELISM) == "123"
    spark.conf.set(LISTING_PARALLELISM, "10000")
    apply_required_conf(spark)


def test_scratch_lives_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/daybar/x-") and a != b
