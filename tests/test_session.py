from quarry.session import cut_lineage, ensure_checkpoint_dir


def test_checkpoint_dir_is_set_once(spark):
    ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    for _ in range(3):
        cut_lineage(spark.range(3)).count()
    assert spark.sparkContext.getCheckpointDir() == before
