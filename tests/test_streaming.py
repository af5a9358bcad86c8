import tempfile
import uuid

from tidemark.operators.monitor import compute_monthly_delay_rate
from tidemark.operators.transform import transform_table
from tidemark.plans.oracle import DRIVER_CONTRACT
from tidemark.sources.adapter import with_delivery_columns
from tidemark.streaming.monitor_stream import start_delay_monitor

from smoke import SMOKE_DIR


def test_stream_equals_batch(spark):
    raw = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet")
    folder = tempfile.mkdtemp(prefix="tidemark-stream-")
    # the file source sees the data arrive as three files
    for i in range(3):
        raw.filter(f"l_orderkey % 3 = {i}").coalesce(1).write.mode("append").parquet(folder)
    table = DRIVER_CONTRACT.table("lineitem")

    def to_lines(df):
        return transform_table(with_delivery_columns(df), table)

    ns = "s" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ns}")
    q = start_delay_monitor(spark, folder, raw.schema, to_lines, f"{ns}.metrics", f"{ns}.alerts", max_files_per_trigger=1)
    q.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.table(f"{ns}.metrics").collect())
    batch = sorted(tuple(r) for r in compute_monthly_delay_rate(to_lines(raw)).collect())
    assert streamed == batch and len(batch) > 10
    assert spark.table(f"{ns}.alerts").count() == sum(1 for r in batch if r[3] > 65.0 or (r[5] is not None and r[5] > 5.0))


def test_stream_restarts_from_checkpoint(spark):
    """Stop after two files, add a third, restart on the same checkpoint:
    only the new file is read and the result equals the batch job."""
    import tempfile as _t

    raw = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet")
    folder = _t.mkdtemp(prefix="tidemark-stream-")
    ckpt = _t.mkdtemp(prefix="tidemark-stream-ckpt-")
    table = DRIVER_CONTRACT.table("lineitem")

    def to_lines(df):
        return transform_table(with_delivery_columns(df), table)

    ns = "r" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ns}")
    for i in range(2):
        raw.filter(f"l_orderkey % 3 = {i}").coalesce(1).write.mode("append").parquet(folder)
    q = start_delay_monitor(spark, folder, raw.schema, to_lines, f"{ns}.metrics", f"{ns}.alerts", checkpoint_location=ckpt)
    q.awaitTermination(300)
    partial = compute_monthly_delay_rate(to_lines(raw.filter("l_orderkey % 3 < 2")))
    assert sorted(map(tuple, spark.table(f"{ns}.metrics").collect())) == sorted(map(tuple, partial.collect()))
    raw.filter("l_orderkey % 3 = 2").coalesce(1).write.mode("append").parquet(folder)
    q = start_delay_monitor(spark, folder, raw.schema, to_lines, f"{ns}.metrics", f"{ns}.alerts", checkpoint_location=ckpt)
    q.awaitTermination(300)
    spark.catalog.refreshTable(f"{ns}.metrics")  # the stream overwrote it from its own session
    full = compute_monthly_delay_rate(to_lines(raw))
    assert sorted(map(tuple, spark.table(f"{ns}.metrics").collect())) == sorted(map(tuple, full.collect()))
