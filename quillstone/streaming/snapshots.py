"""Drift over landed ref snapshots and fingerprints over landed files, each batch by the same operators as a whole table.

An extension: the checks themselves are those of ``operators``; streaming only feeds them what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstone.operators import integrity
from quillstone.sources import files


def ref_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(repo, ref, commit, observed_at) of JSON lines that land in a folder."""
    return spark.readStream.schema("repo string, ref string, commit string, observed_at timestamp").json(folder)


def latest(batch: DataFrame) -> DataFrame:
    """The newest commit of each ref in a batch; the lesser commit where two are equally new."""
    newest = F.max(F.struct("observed_at", F.struct("commit"))).alias("last")
    return batch.groupBy("repo", F.coalesce("ref", F.lit("HEAD")).alias("ref")).agg(newest).select("repo", "ref", "last.col2.commit")


def watch_drift(refs: DataFrame, source: DataFrame, locked: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the findings of each batch of observed refs to the table at ``out``; only refs in the batch are judged, so a quiet ref is no finding. A repeated batch replaces its own."""

    def judge(batch: DataFrame, number: int) -> None:
        seen = latest(batch)
        found = integrity.drift(source.join(seen.select("repo").distinct(), "repo", "left_semi"), locked, seen).where("code <> 'unobserved'")
        found.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return refs.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def watch_files(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append (path, size, sha256) of each file that lands in a folder; each file once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    rows = spark.readStream.format("binaryFile").schema(schema).load(folder)
    prints = files.fingerprinted(rows.select("path", F.col("content").alias("bytes"))).select("path", "size", "sha256")
    return prints.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
