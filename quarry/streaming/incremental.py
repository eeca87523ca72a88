"""Incremental preparation: only files that arrived since the last run are processed."""

from pyspark.sql import functions as F


def incremental(spark, source, target, fn, checkpoint, schema, format="parquet", files_per_batch=1000):
    """Process new files once and return. The checkpoint remembers finished files and
    the file sink commits each batch exactly once, so a second run does nothing."""
    stream = (
        spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(source)
    )
    query = (
        fn(stream).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def incremental_stats(
    spark, source, target, stats, fn, checkpoint, schema, format="parquet", tokens=None, files_per_batch=1000
):
    """The same with one row of counts per batch: rows in, rows out, filtered, tokens.

    `fn` returns its input rows with a boolean `kept`. Output and statistics are
    written under the batch number, so a repeated batch replaces itself.
    """

    def run(batch, number):
        done = fn(batch).persist()
        done.filter("kept").drop("kept").write.mode("overwrite").parquet(f"{target}/batch={number}")
        total = F.sum(F.when(F.col("kept"), tokens)) if tokens is not None else F.lit(None)
        counts = done.agg(
            F.count("*").alias("rows_in"),
            F.count_if("kept").alias("rows_out"),
            F.count_if(~F.col("kept")).alias("filtered"),
            total.cast("bigint").alias("tokens"),
        )
        counts.write.mode("overwrite").parquet(f"{stats}/batch={number}")
        done.unpersist()

    stream = (
        spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(source)
    )
    query = (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
