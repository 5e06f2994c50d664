"""Log sources (S3, S4): files of text, plain or gzip, to a lines table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.functions.sequence import numbered_runs
from driftcheck.session import cut_lineage, ship_package
from driftcheck.sources.files import open_output

# Python's str.splitlines() separators: \r\n and \n \r \v \f \x1c \x1d \x1e \x85 \u2028 \u2029.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
TRAILING_BREAK = r"(?:\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029])\z"
OTHER_BREAK = r"[\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]\z"
DRIVER_LOG_PATH = r"applications/([^/]+)/jobs/([^/]+)/SPARK_DRIVER/(stdout|stderr)(\.gz)?$"


def split_lines(texts: DataFrame, id_col: str = "log_id", text_col: str = "text") -> DataFrame:
    """(id, text) -> (log_id, line_no, line), 1-based line numbers, order kept.

    Same separators as ``str.splitlines``; a trailing line break does not
    produce a last empty line.
    """
    body = F.regexp_replace(F.col(text_col), TRAILING_BREAK, "")
    return texts.select(
        F.col(id_col).alias("log_id"), F.posexplode(F.split(body, LINE_BREAK, -1)).alias("pos", "line")
    ).select("log_id", (F.col("pos") + 1).cast("long").alias("line_no"), "line")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Text files as records between "\\n"s: (path, start, size, record), in order within each (path, start).

    A plain file is cut into splits that start at byte ``start`` and are read
    by different tasks; a compressed one is a single split, read as a stream.
    A record is a row, so only a record must fit a row, never a file.
    """
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), meta["file_size"].alias("size"), F.col("value").alias("record"))


def read_log_records(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` as (log_id = path, line_no, line), cut at "\\n" alone: the lines that a pattern's ``.`` stops at."""
    held = cut_lineage(read_records(spark, path).drop("size").withColumn("__mid", F.monotonically_increasing_id()))
    return numbered_runs(held, ["path"], F.col("start"), 1, "line_no").select(F.col("path").alias("log_id"), "line_no", F.col("record").alias("line"))


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """S3: every file under ``path`` (glob allowed; ``.gz`` is decompressed by Spark) as (log_id = path, line_no, line).

    The lines are those of ``str.splitlines`` of the whole file, numbered from
    1 without gaps, though a plain file is read by as many tasks as it has
    splits: lines are written once as they lie, carrying their place in their
    split, and the splits of a file are added up, a row each. A compressed
    file counts as ended by a line break.
    """
    records = read_records(spark, path)
    pieces = F.split(F.regexp_replace("record", r"\r\z", ""), LINE_BREAK, -1)
    size = F.when(F.col("k") == 0, F.octet_length("record") + 1).otherwise(0)
    # a break before the end of a record opens a line, unless the file ends there
    odd = (F.col("k") == F.col("n") - 1) & F.col("record").rlike(OTHER_BREAK)
    lines = records.select("*", F.size(pieces).alias("n"), F.posexplode(pieces).alias("k", "line"))
    held = cut_lineage(lines.select("path", "start", "size", size.alias("bytes"), odd.alias("odd"), "line", F.monotonically_increasing_id().alias("__mid")))
    numbered = numbered_runs(held, ["path"], F.col("start"), 1, "line_no")
    if not held.where("odd").isEmpty():
        # the last record has no break behind it if records and breaks are one byte more than the file
        unended = held.groupBy("path").agg(F.count(F.lit(1)).alias("line_no"), (F.sum("bytes") == F.max("size") + 1).alias("open")).where("open")
        numbered = numbered.join(unended, ["path", "line_no"], "left").where(~(F.col("odd") & F.coalesce("open", F.lit(False))))
    return numbered.select(F.col("path").alias("log_id"), "line_no", "line")


def read_driver_log_texts(spark: SparkSession, root: str) -> DataFrame:
    """S4 as whole texts: (log_id = job id, application_id, stream, text), one row per stream file."""
    glob = f"{root.rstrip('/')}/applications/*/jobs/*/SPARK_DRIVER/*"
    raw = spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
    return raw.select(
        F.regexp_extract("path", DRIVER_LOG_PATH, 2).alias("log_id"),
        F.regexp_extract("path", DRIVER_LOG_PATH, 1).alias("application_id"),
        F.regexp_extract("path", DRIVER_LOG_PATH, 3).alias("stream"),
        "text",
    ).filter(F.col("stream") != "")


DRIVER_LOG_GLOB = "applications/*/jobs/*/SPARK_DRIVER/*"


def _driver_lines(lines: DataFrame) -> DataFrame:
    part = lambda k: F.regexp_extract("log_id", DRIVER_LOG_PATH, k)
    tagged = lines.select(part(2).alias("job"), part(1).alias("application_id"), part(3).alias("stream"), "line_no", "line")
    return tagged.where("stream <> ''").withColumnRenamed("job", "log_id")


def read_driver_logs(spark: SparkSession, root: str) -> DataFrame:
    """``<root>/.../applications/<app>/jobs/<job>/SPARK_DRIVER/<stream>[.gz]``.

    Returns (log_id = job id, application_id, stream, line_no, line) with the
    lines of :func:`read_log_files`; a missing stream simply has no rows.
    """
    return _driver_lines(read_log_files(spark, f"{root.rstrip('/')}/{DRIVER_LOG_GLOB}"))


def read_driver_records(spark: SparkSession, root: str) -> DataFrame:
    """S4 cut at "\\n" alone, for rules: a ``\\r`` stays in its line."""
    return _driver_lines(read_log_records(spark, f"{root.rstrip('/')}/{DRIVER_LOG_GLOB}"))


def _write_streams(root: str, compress: bool, batches):
    import gzip

    import pyarrow as pa

    now, raw, out, done = None, None, None, []

    def close():
        if out is not None:
            if out is not raw:
                out.close()
            raw.close()
            done.append(now)

    for batch in batches:
        for app, job, stream, line in zip(*(batch.column(c).to_pylist() for c in ("application_id", "log_id", "stream", "line"))):
            if (app, job, stream) != now:
                close()
                now = (app, job, stream)
                raw = open_output(f"{root}/applications/{app}/jobs/{job}/SPARK_DRIVER/{stream}" + ".gz" * compress)
                out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if compress else raw
            out.write((line + "\n").encode())
    close()
    names = ["application_id", "log_id", "stream"]
    yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in range(3)], names)


def write_driver_logs(lines: DataFrame, root: str, compress: bool = True) -> DataFrame:
    """Driver logs in the layout of :func:`read_driver_logs`; returns the streams written.

    ``lines`` has application_id, log_id, stream, line_no, line. A stream is a
    file, so one task writes it, line by line. ``root`` is a folder that all
    executors reach; a repeated task writes the same file again.
    """
    ship_package(lines.sparkSession)
    key = ["application_id", "log_id", "stream"]
    rows = lines.select(*(F.col(c).cast("string").alias(c) for c in key), "line_no", F.coalesce("line", F.lit("")).alias("line"))
    dealt = rows.repartition(*key).sortWithinPartitions(*key, "line_no").drop("line_no")
    return cut_lineage(dealt.mapInArrow(partial(_write_streams, root.rstrip("/"), compress), "application_id string, log_id string, stream string"))
