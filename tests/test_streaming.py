"""The streaming ratings ingest gives the same table as the batch operator, also across batches and replays."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.operators.ingest import RATING_COLUMNS, ratings_ingest, ratings_table
from ledgerline.sources import bindings as b
from ledgerline.streaming.ratings import start_ratings_ingest
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-stream-")
    src, table, rejects, ck = (os.path.join(root, n) for n in ("in", "table", "rejects", "ck"))
    raw = b.runner_ratings_raw(spark, SF_SMALL)
    # two arrivals
    raw.where(F.col("order_id") % 2 == 0).write.parquet(os.path.join(src, "part-a"))
    q = start_ratings_ingest(spark, src + "/*", table, rejects, ck, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    raw.where(F.col("order_id") % 2 == 1).write.parquet(os.path.join(src, "part-b"))
    q = start_ratings_ingest(spark, src + "/*", table, rejects, ck, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()

    got = spark.read.parquet(table).select(*RATING_COLUMNS)
    want = ratings_table(ratings_ingest(raw))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    n_rejected = spark.read.parquet(rejects).count()
    assert n_rejected + got.count() == raw.count()
