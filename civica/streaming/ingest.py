"""Incremental ingest of a landing folder (S4 as a stream).

Yearly result files arrive over time.  Instead of re-reading the whole
folder, a Structured Streaming file source picks up only new files; the
header harmonisation is a plain projection, so it runs inside the stream;
the Parquet file sink with a checkpoint gives exactly-once output across
restarts and executor loss.  ``availableNow`` processes what has landed
and stops, so the same code serves scheduled batch runs.
"""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civica.session import scratch_path
from civica.sources.lake import first_line, header_lines, list_files, read_with_names, unique_header_names


def landing_schema(spark: SparkSession, folder: str, sep: str = ",") -> StructType:
    """All-string schema from the header of the first landed file."""
    files = list_files(spark, folder)
    if not files:
        raise ValueError(f"no file in {folder}")
    names = unique_header_names(next(csv.reader([first_line(spark, files[0])], delimiter=sep)))
    return StructType([StructField(n, StringType(), True) for n in names])


def check_headers(spark: SparkSession, folder: str, schema: StructType, sep: str = ",") -> None:
    """An error if a landed file has other headers than the schema: its
    values would go to the wrong columns."""
    for f, header in header_lines(spark, list_files(spark, folder)).items():
        names = unique_header_names(next(csv.reader([header], delimiter=sep), []))
        if header and names != schema.names:
            raise ValueError(f"{f} has the headers {names}, not {schema.names}")


def ingest_stream(spark: SparkSession, landing: str, target: str, transform: Callable[[DataFrame], DataFrame] = None,
                  sep: str = ",", checkpoint: str | None = None, schema: StructType | None = None,
                  source_col: str = "source_file") -> str:
    """Append the rows of files not yet seen in ``landing`` to the Parquet
    dataset ``target`` and return the checkpoint location used.  Files whose
    headers differ are an error: one stream takes one layout."""
    schema = schema or landing_schema(spark, landing, sep)
    check_headers(spark, landing, schema, sep)
    ckpt = checkpoint or scratch_path(spark, "ingest-checkpoint")
    stream = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
              .option("enforceSchema", True).csv(landing)
              .withColumn(source_col, F.col("_metadata.file_name")))
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    return ckpt


def layout_name(header: str) -> str:
    """The name of the table that files with this header line go to."""
    return "layout_" + hashlib.sha256(header.encode()).hexdigest()[:16]


def route_stream(spark: SparkSession, landing: str, target: str, sep: str = ",", checkpoint: str | None = None,
                 source_col: str = "source_file", files_per_batch: int = 1000) -> str:
    """S4 for a folder in which several layouts land: the files of each
    header line go to a Parquet table of their own, ``target/layout_…``, once.
    Returns the checkpoint location.

    The stream carries file names, not contents.  A batch takes the new
    names, reads their first lines, and reads the files of each layout in one
    distributed scan.  A layout's rows of one batch are a folder
    ``batch=<id>`` that is overwritten, so a batch that runs again after a
    failure doubles nothing."""
    ckpt = checkpoint or scratch_path(spark, "route-checkpoint")
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch) \
        .load(landing).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        groups: dict[str, list[str]] = {}
        for f, header in header_lines(spark, sorted(r["path"] for r in batch.collect())).items():
            if header:
                groups.setdefault(header, []).append(f)
        for header, files in groups.items():
            columns = unique_header_names(next(csv.reader([header], delimiter=sep)))
            rows = read_with_names(spark, files, columns, sep=sep).withColumn(source_col, F.col("_metadata.file_name"))
            rows.write.mode("overwrite").parquet(f"{target}/{layout_name(header)}/batch={batch_id}")

    q = names.writeStream.foreachBatch(load).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return ckpt
