"""The resolver drift report kept up to date while log files keep arriving.

Same extraction, range filter and side sums as the batch report
(:func:`logledger.plans.reconcile.resolver_drift`); the aggregate's state is
one row per resource, kept in the checkpoint folder, so a restarted query
resumes where it stopped and each trigger only reads new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logledger.functions.flags import drift_flag
from logledger.functions.text import signed_text
from logledger.operators.aggregate import side_sums
from logledger.operators.extract import extract_resolver_tagged
from logledger.operators.filters import within_any
from logledger.session import hadoop_path, remove_folder, scratch_path

KEEP = 3


def drift_stream(spark: SparkSession, control_dir: str, candidate_dir: str, shared,
                 control_range=None, candidate_range=None, count_only: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (resource, control_sum, candidate_sum, difference, flag)."""
    def read(path):
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)

    c = extract_resolver_tagged(read(control_dir), "control", count_only).filter(
        within_any("pub_id", shared, control_range))
    d = extract_resolver_tagged(read(candidate_dir), "candidate", count_only).filter(
        within_any("pub_id", shared, candidate_range))
    s = side_sums(c.unionByName(d), ["resource"])
    diff = F.col("candidate_sum") - F.col("control_sum")
    return s.select("resource", "control_sum", "candidate_sum", signed_text(diff).alias("difference"),
                    drift_flag(F.col("control_sum"), diff).alias("flag"))


def start_drift_to_table(stream: DataFrame, out_path: str, checkpoint: str | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Write each trigger's full report (complete mode) to a folder of its own below ``out_path``.

    A reader (:func:`read_report`) so always finds a whole report; the last
    ``KEEP`` stay, for readers that have begun with one of them.  The state
    and file log live in ``checkpoint`` (default: a folder under
    ``spark.checkpoint.dir``)."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "drift-stream-ckpt")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/trigger={number}")
        for old in _triggers(spark, out_path)[:-KEEP]:
            remove_folder(spark, f"{out_path}/trigger={old}")

    w = stream.writeStream.outputMode("complete").option("checkpointLocation", ckpt).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_report(spark: SparkSession, out_path: str) -> DataFrame:
    """The report of the last trigger that was written whole; its folder alone is read."""
    return spark.read.parquet(f"{out_path}/trigger={_triggers(spark, out_path)[-1]}")


def _triggers(spark: SparkSession, out_path: str) -> list[int]:
    """Numbers of the triggers whose reports are whole (their folders hold the writer's mark), in order."""
    store, place = hadoop_path(spark, out_path)
    names = [s.getPath() for s in store.listStatus(place) if s.isDirectory()]
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().partition("=")[2]) for p in names if store.exists(mark(p, "_SUCCESS")))
