"""Log reduction and search over a table of log lines.

A log is the set of rows of one ``log_id`` in a lines table
``(log_id, line_no, line)``; ``line_no`` orders the lines (it need not be
contiguous). Nothing here gathers a whole log into one task:

* head / tail / first-k selections are ``row_number() <= k`` filters, which
  Spark plans as a WindowGroupLimit (map-side partial top-k per partition,
  then a final top-k), so a log with a third of all lines still moves only
  k rows per map task;
* exception bounds are ``groupBy(log_id)`` minima (partial aggregation) joined
  back on ``log_id`` (AQE splits a skewed join partition);
* only bounded results (a reduced text, at most k grep hits) are gathered
  into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftcheck.functions.joins import broadcast_if_small
from driftcheck.session import cut_lineage

# Fixed values kept from the original reader and tools.
TRUNCATION_MARKER = "... [TRUNCATED] ..."
FIRST_LINES_COUNT = 50
LAST_LINES_COUNT = 200
DEFAULT_MAX_BYTES = 500_000
GREP_MAX_HITS = 50
STREAM_ORDER = ("stdout", "stderr")
STREAM_HEADER = "===== SPARK_DRIVER {stream} ====="

# Python's str.strip() whitespace: Unicode White_Space plus the \x1c-\x1f separators.
BLANK_LINE_REGEX = r"(?U)^[\s\x1c-\x1f]*$"

SECTION_WHOLE, SECTION_HEAD, SECTION_SEP1, SECTION_BLOCK, SECTION_SEP2, SECTION_TAIL = 0, 1, 2, 3, 4, 5


def is_exception_line(line: Column) -> Column:
    return line.contains("Traceback") | line.contains("Exception")


def is_blank_line(line: Column) -> Column:
    return line.rlike(BLANK_LINE_REGEX)


def log_sizes(lines: DataFrame) -> DataFrame:
    """(log_id, n_lines, n_bytes): UTF-8 size of the lines joined by newlines."""
    return lines.groupBy("log_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        (F.sum(F.octet_length("line")) + F.count(F.lit(1)) - 1).alias("n_bytes"),
    )


def exception_bounds(lines: DataFrame) -> DataFrame:
    """L2 bounds: (log_id, block_start, block_end); block_end is null when the block runs to the end.

    Start is the first line containing ``Traceback`` or ``Exception``
    (case-sensitive); end is the next blank (whitespace-only) line. The
    per-log starts are materialized once and broadcast when small, so the
    end pass does not shuffle the lines.
    """
    starts = cut_lineage(
        lines.filter(is_exception_line(F.col("line"))).groupBy("log_id").agg(F.min("line_no").alias("block_start"))
    )
    ends = (
        lines.join(broadcast_if_small(starts), "log_id")
        .filter((F.col("line_no") > F.col("block_start")) & is_blank_line(F.col("line")))
        .groupBy("log_id")
        .agg(F.min("line_no").alias("block_end"))
    )
    return starts.join(ends, "log_id", "left")


def exception_block(lines: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """L2: the lines of the first exception block of every log."""
    b = bounds if bounds is not None else cut_lineage(exception_bounds(lines))
    return (
        lines.join(broadcast_if_small(b), "log_id")
        .filter(
            (F.col("line_no") >= F.col("block_start"))
            & (F.col("block_end").isNull() | (F.col("line_no") < F.col("block_end")))
        )
        .select("log_id", "line_no", "line")
    )


def first_k(lines: DataFrame, k: int, descending: bool = False) -> DataFrame:
    """First (or last) k lines of every log (WindowGroupLimit top-k)."""
    order = F.col("line_no").desc() if descending else F.col("line_no").asc()
    w = Window.partitionBy("log_id").orderBy(order)
    return lines.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def _separator_rows(ids: DataFrame, section: int, marker: str) -> DataFrame:
    rows = F.array(
        F.struct(F.lit(1).cast("long").alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(2).cast("long").alias("line_no"), F.lit(marker).alias("line")),
        F.struct(F.lit(3).cast("long").alias("line_no"), F.lit("").alias("line")),
    )
    return ids.select("log_id", F.lit(section).alias("section"), F.inline(rows))


def reduce_log(
    lines: DataFrame,
    max_bytes: int = DEFAULT_MAX_BYTES,
    head: int = FIRST_LINES_COUNT,
    tail: int = LAST_LINES_COUNT,
    marker: str = TRUNCATION_MARKER,
    contiguous: bool = False,
) -> DataFrame:
    """L1: reduced logs as rows (log_id, section, line_no, line).

    A log of at most ``max_bytes`` UTF-8 bytes is kept whole (section 0).
    A larger one becomes: first ``head`` lines, "", marker, "", the first
    exception block with its own "", marker, "" (if there is one), and the
    last ``tail`` lines. Sections may overlap; duplicates are kept. Order
    inside a log is (section, line_no).

    Passes over the lines: one aggregate (size, exception start), narrow
    passes over (log_id, line_no[, blank]) of the large logs only (block end,
    head and tail line-number thresholds by WindowGroupLimit), and one final
    pass that tags every kept line with its sections: five in all. With
    ``contiguous=True`` (line numbers run first..first+n-1 without gaps, as
    ``split_lines`` produces) the head and tail thresholds follow from the
    line count and those two passes are skipped: three in all. The per-log
    tables are materialized in the shared folder (eager), and the separator
    rows come from them, not from the lines.
    """
    lines = lines.select("log_id", F.col("line_no").cast("long").alias("line_no"), "line")
    # per-log tables (one row per log) are materialized so no branch re-scans the lines for them
    stats = cut_lineage(lines.groupBy("log_id").agg(
        (F.sum(F.octet_length("line")) + F.count(F.lit(1)) - 1).alias("n_bytes"),
        F.min(F.when(is_exception_line(F.col("line")), F.col("line_no"))).alias("block_start"),
        F.count(F.lit(1)).alias("n_lines"),
        F.min("line_no").alias("first_no"),
    ))
    big = stats.filter(F.col("n_bytes") > max_bytes).select("log_id", "block_start")
    if big.isEmpty():  # every log fits: keep all lines, no further pass (reads the small per-log table)
        return lines.select("log_id", F.lit(SECTION_WHOLE).alias("section"), "line_no", "line")
    big_lines = lines.join(big.select("log_id"), "log_id", "left_semi")
    ends = (
        lines.select("log_id", "line_no", "line").join(big.filter(F.col("block_start").isNotNull()), "log_id")
        .filter((F.col("line_no") > F.col("block_start")) & is_blank_line(F.col("line")))
        .groupBy("log_id").agg(F.min("line_no").alias("block_end"))
    )
    if contiguous:
        bounds = stats.join(ends, "log_id", "left").select(
            "*",
            (F.col("first_no") + F.lit(head) - 1).alias("head_last"),
            (F.col("first_no") + F.col("n_lines") - F.lit(tail)).alias("tail_first"),
        )
    else:
        head_last = first_k(big_lines.select("log_id", "line_no"), head).groupBy("log_id").agg(F.max("line_no").alias("head_last"))
        tail_first = first_k(big_lines.select("log_id", "line_no"), tail, descending=True).groupBy("log_id").agg(
            F.min("line_no").alias("tail_first")
        )
        bounds = stats.join(ends, "log_id", "left").join(head_last, "log_id", "left").join(tail_first, "log_id", "left")
    bounds = cut_lineage(bounds.withColumn("is_big", F.col("n_bytes") > max_bytes))
    n, start, end = F.col("line_no"), F.col("block_start"), F.col("block_end")
    in_block = start.isNotNull() & (n >= start) & (end.isNull() | (n < end))
    sections = F.array_compact(
        F.array(
            F.when(n <= F.col("head_last"), F.lit(SECTION_HEAD)),
            F.when(in_block, F.lit(SECTION_BLOCK)),
            F.when(n >= F.col("tail_first"), F.lit(SECTION_TAIL)),
        )
    )
    # Usually few logs exceed the limit: their bounds (and ids) are broadcast, so
    # neither the whole logs nor the large ones shuffle their lines.
    big_bounds = broadcast_if_small(bounds.filter(F.col("is_big")))
    whole = lines.join(big_bounds.select("log_id"), "log_id", "left_anti").select(
        "log_id", F.lit(SECTION_WHOLE).alias("section"), "line_no", "line"
    )
    kept = whole.unionByName(
        lines.join(big_bounds, "log_id").select("log_id", F.explode(sections).alias("section"), "line_no", "line")
    )
    is_big, start = F.col("is_big"), F.col("block_start")
    seps = _separator_rows(bounds.filter(is_big).select("log_id"), SECTION_SEP1, marker).unionByName(
        _separator_rows(bounds.filter(is_big & start.isNotNull()).select("log_id"), SECTION_SEP2, marker)
    )
    return kept.unionByName(seps).select("log_id", "section", "line_no", "line")


def reduce_texts(
    texts: DataFrame,
    max_bytes: int = DEFAULT_MAX_BYTES,
    head: int = FIRST_LINES_COUNT,
    tail: int = LAST_LINES_COUNT,
    marker: str = TRUNCATION_MARKER,
) -> DataFrame:
    """L1 on whole texts ``(log_id, text)`` (e.g. ``wholetext`` file reads) -> ``(log_id, text)``.

    A text of at most ``max_bytes`` UTF-8 bytes is returned unchanged without
    leaving its task (no shuffle: at scale most logs take this path). Only
    larger texts are split into lines, reduced and joined again with "\n".
    """
    from driftcheck.sources.logs import split_lines

    size = F.octet_length("text")
    small = texts.filter(size <= max_bytes).select("log_id", "text")
    big = texts.filter(size > max_bytes).select("log_id", "text")
    reduced = reduce_log(split_lines(big), max_bytes=-1, head=head, tail=tail, marker=marker, contiguous=True)
    return small.unionByName(reduced_text(reduced))


def reduced_text(reduced: DataFrame) -> DataFrame:
    """(log_id, text): reduced rows joined by newlines in (section, line_no) order.

    Bounded per log: at most ``max_bytes`` for a whole log, else head + tail +
    one exception block.
    """
    return reduced.groupBy("log_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("section", "line_no", "line"))), lambda x: x["line"]),
            "\n",
        ).alias("text")
    )


def grep(lines: DataFrame, pattern: str, max_hits: int = GREP_MAX_HITS) -> DataFrame:
    """L4: case-insensitive substring search per log.

    Returns (log_id, n_hits, result): the first ``max_hits`` matching lines
    joined by newlines, or a message naming the pattern when nothing matched.
    """
    needle = pattern.lower()
    hit = F.lower("line").contains(needle)
    # one aggregate gives every log with its hit count (zero included)
    counts = lines.groupBy("log_id").agg(F.count_if(hit).alias("n_hits"))
    firsts = first_k(lines.filter(hit), max_hits).groupBy("log_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"
        ).alias("hits_text")
    )
    msg = f"No lines in the log matched {pattern!r}."
    return counts.join(firsts, "log_id", "left").select(
        "log_id", "n_hits", F.coalesce("hits_text", F.lit(msg)).alias("result")
    )


def merge_streams(stream_lines: DataFrame) -> DataFrame:
    """Stdout before stderr, each present stream preceded by its header.

    Input (log_id, stream, line_no, line); output (log_id, stream_rank, part,
    line_no, line) in the order (stream_rank, part, line_no): part 0 is the
    header row, part 1 the stream's lines. Missing streams are skipped.
    """
    rank = F.when(F.col("stream") == STREAM_ORDER[0], 0).when(F.col("stream") == STREAM_ORDER[1], 1)
    body = stream_lines.filter(rank.isNotNull()).select(
        "log_id", rank.alias("stream_rank"), F.lit(1).alias("part"), F.col("line_no").cast("long").alias("line_no"), "line", "stream"
    )
    headers = body.groupBy("log_id", "stream_rank", "stream").agg(F.lit(0).cast("long").alias("line_no")).select(
        "log_id", "stream_rank", F.lit(0).alias("part"), "line_no",
        F.format_string(STREAM_HEADER.replace("{stream}", "%s"), "stream").alias("line"),
    )
    return headers.unionByName(body.drop("stream"))


def stream_texts(stream_lines: DataFrame) -> DataFrame:
    """(log_id, stream, text): the whole text of each stream, its lines joined by newlines."""
    return stream_lines.groupBy("log_id", "stream").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text")
    )


def merge_stream_texts(streams: DataFrame) -> DataFrame:
    """L5 on whole stream texts (log_id, stream, text) -> (log_id, text).

    Byte for byte the merged file: for stdout then stderr, when present,
    ``===== SPARK_DRIVER <stream> =====\n`` + content + ``\n``. A group has
    at most two rows, so nothing unbounded is gathered.
    """
    rank = F.when(F.col("stream") == STREAM_ORDER[0], 0).when(F.col("stream") == STREAM_ORDER[1], 1)
    part = F.concat(F.format_string(STREAM_HEADER.replace("{stream}", "%s"), "stream"), F.lit("\n"), F.col("text"), F.lit("\n"))
    return (
        streams.filter(rank.isNotNull())
        .select("log_id", F.struct(rank.alias("r"), part.alias("t")).alias("p"))
        .groupBy("log_id")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["t"]), "").alias("text"))
    )


def merged_lines(stream_lines: DataFrame) -> DataFrame:
    """L5 as the lines of the merged file: (log_id, line_no, line), ``line_no`` an ordered struct.

    Each stream counts as ended by a line break, so the break that the merge
    adds leaves an empty line behind it.
    """
    merged = merge_streams(stream_lines)
    ends = merged.where("part = 0").select("log_id", "stream_rank", F.lit(2).alias("part"), "line_no", F.lit("").alias("line"))
    return merged.unionByName(ends).select("log_id", F.struct("stream_rank", "part", "line_no").alias("line_no"), "line")


def merge_chunks(stream_lines: DataFrame, lines_per_chunk: int = 1000) -> DataFrame:
    """L5 as (log_id, chunk_no, text): the merged text in chunks of at most so many lines.

    The texts of a log in order of chunk_no, one after the other, are
    :func:`merge_stream_texts`; no row or task holds a whole log.
    """
    from driftcheck.functions.sequence import chunked

    rows = merge_streams(stream_lines)
    chunks = chunked(rows, "log_id", ["stream_rank", "part", "line_no"], F.concat(F.coalesce("line", F.lit("")), F.lit("\n")), lines_per_chunk)
    return chunks.select("log_id", "chunk_no", F.array_join("items", "").alias("text"))


def excerpt(col: Column | str, n: int) -> Column:
    """The first ``n`` characters (code points) of a text."""
    return F.substring(F.col(col) if isinstance(col, str) else col, 1, n)


def job_status(exit_code: Column, started_at: Column | None = None, ended_at: Column | None = None, timeout_seconds: Column | None = None) -> tuple[Column, Column]:
    """(effective exit code, status); a run longer than the timeout counts as exit -1."""
    code = exit_code
    if timeout_seconds is not None:
        took = F.unix_timestamp(ended_at) - F.unix_timestamp(started_at)
        code = F.when(took > timeout_seconds, F.lit(-1)).otherwise(exit_code)
    return code, F.when(code == 0, "SUCCEEDED").otherwise("FAILED")


def translate_status(status: Column) -> Column:
    """SUCCESS -> SUCCEEDED, every other value unchanged."""
    return F.when(status == "SUCCESS", F.lit("SUCCEEDED")).otherwise(status)


def recover_job_run_id(df: DataFrame, id_col: str = "job_run_id", status_col: str = "status", cause_col: str = "cause") -> DataFrame:
    """Fill job id and status from a JSON ``cause`` when the id is absent.

    Both ``JobRunId`` and ``State`` must be present; malformed JSON, a
    non-object or a missing key leaves the row unchanged.
    """
    jid = F.get_json_object(F.col(cause_col), "$.JobRunId")
    state = F.get_json_object(F.col(cause_col), "$.State")
    use = F.col(id_col).isNull() & F.col(cause_col).isNotNull() & jid.isNotNull() & state.isNotNull()
    return df.withColumn(status_col, F.when(use, state).otherwise(F.col(status_col))).withColumn(
        id_col, F.when(use, jid).otherwise(F.col(id_col))
    )


def is_infrastructure_failure(status: Column, job_run_id: Column) -> Column:
    """The job never started: status is not SUCCESS and there is no job id."""
    return ~F.coalesce(status == "SUCCESS", F.lit(False)) & job_run_id.isNull()
