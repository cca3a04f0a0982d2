"""The shared folder comes from the session (spark.checkpoint.dir); nothing local is invented."""

from ledgerline.session import checkpoint_dir
from ledgerline.sources.sinks import table_path


def test_checkpoint_dir_is_read_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured
    assert checkpoint_dir(spark) == configured
    assert table_path(spark, "x").startswith(configured.rstrip("/") + "/tables/")


def test_explicit_base_wins(spark):
    assert table_path(spark, "x", base="/shared/warehouse") == "/shared/warehouse/tables/x"
