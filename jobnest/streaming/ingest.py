"""Day-by-day accumulation (K4) as an incremental Structured Streaming ingest.

``readStream`` over the landing folder picks up only files it has not seen
(the checkpoint's source log remembers them); ``trigger(availableNow=True)``
processes what is there and stops, so a daily scheduler can run it like a
batch job.  The file sink commits through its own metadata log, so a retried
micro-batch (lost executor, restarted driver) is written exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def ingest_available(spark: SparkSession, landing_dir: str, schema: T.StructType | str,
                     target_dir: str, checkpoint_dir: str, fmt: str = "json",
                     options: dict[str, str] | None = None) -> None:
    """Append every not-yet-ingested landed file to ``target_dir`` (Parquet), then stop."""
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    q = (reader.load(landing_dir).writeStream
         .format("parquet")
         .option("path", target_dir)
         .option("checkpointLocation", checkpoint_dir)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def ingested(spark: SparkSession, target_dir: str) -> DataFrame:
    """Everything committed by the sink so far (read through its metadata log)."""
    return spark.read.parquet(target_dir)


def ingest_vacancies(spark: SparkSession, landing_dir: str, good_dir: str, bad_dir: str,
                     checkpoint_dir: str) -> None:
    """I1 + P1 + X2 as one stream: new landed (url, body) files -> good rows and quarantined rows.

    Two outputs need ``foreachBatch``.  Each write replaces its own
    ``run_id=/batch_id=`` folder, also with no rows, so a micro-batch that is
    replayed after a failure overwrites its earlier output.  ``run_id`` is the
    query's id, which the checkpoint keeps: a stream that starts over without
    its checkpoint writes beside earlier batches, never over them.
    """
    from jobnest.operators.vacancies import quarantine, vacancy_project

    def write(batch: DataFrame, batch_id: int) -> None:
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        projected = vacancy_project(batch, keep=["url"]).persist()   # parsed once for both outputs
        for df, path in zip(quarantine(projected), (good_dir, bad_dir), strict=True):
            df.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")
        projected.unpersist()

    q = (spark.readStream.schema("url STRING, body STRING").json(landing_dir)
         .writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
