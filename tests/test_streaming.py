from ferry.plans import fixtures as FX
from ferry.session import run_dir
from ferry.streaming.incremental import stream_copy


def test_stream_copy_matches_batch(spark, sf_small):
    schema = FX.read(spark, sf_small, "orders").schema
    target = run_dir(spark, "test-stream")
    log = stream_copy(spark, f"{sf_small}/orders*.parquet", schema, target)
    assert log and all(b["rows_in"] == b["rows_written"] for b in log)
    copied = spark.read.parquet(target).drop("U_ID", "batch")
    expected = FX.orders_target(spark, sf_small)
    assert copied.count() == expected.count()
    assert copied.exceptAll(expected).count() == 0
