"""New raw files as they arrive, through the same batch functions.

The model is run-to-run state, so a stream is a row of small runs: each micro-batch of lines is
projected, screened and written to a folder of its own, which a batch that runs again replaces.
Of rows of a batch with the same object id the first by file and place stays; rows without an id all stay. Repeats across
batches are left to the seen store, as they are between batch runs. A line that isn't a JSON object
fails its batch, as it fails a batch run, unless a folder for such lines is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import strip
from ..operators import postings, rules
from ..sources import jsonl
from ..tables import scope


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(line, file, start) of the lines that land in ``folder``; start is where a line's split of the file begins."""
    lines = spark.readStream.schema("value string").text(folder).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return lines.where(strip(F.col("line")) != "")


def screen_batch(lines: DataFrame, settings: rules.Screen) -> DataFrame:
    """Screened postings of a batch of whole records (file, start, ord, record), the first of each object id by its place."""
    flat = postings.project(lines.select(F.struct("file", "start", "ord").alias("ord"), "record"))
    known = flat.where("object_id <> ''").groupBy("object_id").agg(F.min_by(F.struct(*flat.columns), "ord").alias("r")).select("r.*")
    flat, known = (d.withColumn("ord", F.col("ord.ord")) for d in (flat, known))
    return rules.screen(known.unionByName(flat.where("object_id = ''")), settings)


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, settings: rules.Screen = rules.Screen(), bad: str | None = None) -> StreamingQuery:
    """Write each batch to ``out``/epoch=n, and its lines that aren't JSON objects to ``bad``/epoch=n."""

    def put(batch: DataFrame, epoch: int) -> None:
        with scope(batch.sparkSession):
            put_lines(batch, epoch)

    def put_lines(batch: DataFrame, epoch: int) -> None:
        lines = batch.select(F.monotonically_increasing_id().alias("ord"), "line", "file", "start", F.try_parse_json("line").alias("record"))
        wrong = jsonl.malformed(lines)
        if bad:
            wrong.write.mode("overwrite").json(f"{bad}/epoch={epoch}")
        elif (first := wrong.first()) is not None:
            raise jsonl.BadRecord(f"{first['file']}: not a JSON object: {first['line'][:160]}")
        good = lines.where(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")))
        screen_batch(good, settings).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return read_lines(spark, folder).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).start()
