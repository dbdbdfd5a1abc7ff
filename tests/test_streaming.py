"""The micro-batch adapter profiles each batch once, even when a batch is replayed."""

from pyspark.sql import functions as F

from tablewise.session import shared_dir


def test_profile_batches(spark, sf001):
    schema = spark.read.parquet(f"{sf001}/events.parquet").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf001))
    from tablewise.streaming import profile_batches
    sink = shared_dir(spark, "stream-sink")
    ckpt = shared_dir(spark, "stream-ckpt")
    q = profile_batches(stream, sink, "events", ckpt, approx_distinct=False,
                        trigger={"availableNow": True})
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    size = out.filter((F.col("name") == "Size")).agg(F.sum("value")).first()[0]
    assert size == spark.read.parquet(f"{sf001}/events.parquet").count()
    assert set(out.columns) >= {"entity", "instance", "name", "value", "table", "batch_id"}
