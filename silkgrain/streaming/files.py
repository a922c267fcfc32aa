"""The same stages over a growing folder of documents: each micro-batch runs the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from silkgrain.plans import pipeline


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, schema: str = "document_id long, text string", once: bool = True) -> StreamingQuery:
    """Label documents as their parquet files arrive. A batch that failed and is run again is
    taken up by each stage where that stage had stopped."""
    def stage(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            pipeline.run(batch.sparkSession, batch, out)

    w = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
