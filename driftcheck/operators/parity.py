"""Baseline-vs-target table parity.

Every pair costs exactly one aggregate pass per side: row count, the sum of
every numeric column and the null count of every shared column are computed
by a single ``agg`` (map-side partial aggregation, one tiny row per side).
Schema facts are metadata. All comparisons, statuses, details and the rollup
are DataFrame expressions over those tiny profile rows, so a fleet of table
pairs is one Spark plan, not a Python loop over actions.

Deliberate deviations from the per-record original:
  * numeric columns are scalar Integer/Long/Float/Double/Decimal columns
    (ShortType/ByteType excluded as in the original marker list); nested
    types whose type string merely contains a marker are excluded, because
    summing them is an analysis error;
  * a NaN sum differs from a number and equals another NaN sum;
  * a target column of another type is summed with ``try_cast`` to double;
  * details are sorted JSON instead of Python reprs, so output is stable.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcheck.session import cut_lineage, materialize_path, path_exists

# Fixed values shared with the original validator.
CHECK_ROW_COUNT = "row_count_match"
CHECK_SCHEMA = "schema_match"
CHECK_COLUMN_DIFF = "column_level_diff"
CHECK_NULL_COUNT = "null_count_diff"
DEFAULT_SEVERITY = "warning"
DEFAULT_TOLERANCE = 0.0001
NUMERIC_SCALARS = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

CHECK_SPEC_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("severity", T.StringType()),
            T.StructField("config", T.MapType(T.StringType(), T.StringType())),
        ]
    )
)

DEFAULT_CHECKS_JSON = (
    '[{"name": "row_count_match", "type": "exact", "severity": "critical"},'
    ' {"name": "schema_match", "type": "exact", "severity": "critical"},'
    ' {"name": "column_level_diff", "type": "tolerance", "severity": "warning",'
    ' "config": {"tolerance": "0.0001"}},'
    ' {"name": "null_count_diff", "type": "exact", "severity": "warning"}]'
)


@dataclass(frozen=True)
class TablePair:
    """One baseline/target pair; ``target_status`` drives the skip rule."""

    pair_id: str
    baseline: DataFrame
    target: DataFrame
    target_status: str = "SUCCEEDED"
    checks_json: str | None = None


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(baseline: DataFrame, target: DataFrame) -> list[str]:
    """Baseline scalar numeric columns whose name also exists in target."""
    tcols = set(target.columns)
    return [
        f.name
        for f in baseline.schema.fields
        if isinstance(f.dataType, NUMERIC_SCALARS) and f.name in tcols
    ]


def shared_columns(baseline: DataFrame, target: DataFrame) -> list[str]:
    """Baseline columns (in baseline order) that the target also has."""
    tcols = set(target.columns)
    return [c for c in baseline.columns if c in tcols]


def _bq(name: str) -> str:
    """A column name as a back-quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _sq(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _exact_sum(c: str, dt: T.DataType) -> str:
    """SQL text of an exact sum as canonical decimal text; null where the type is not exact (floats) or the sum overflows."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        total = f"try_sum(CAST({_bq(c)} AS DECIMAL(20,0)))"
    elif isinstance(dt, T.DecimalType):
        total = f"try_sum(CAST({_bq(c)} AS DECIMAL(38,{dt.scale})))"
    else:
        return "CAST(NULL AS STRING)"
    return f"CAST({total} AS STRING)"


def side_profile(df: DataFrame, pair_id: str, side: str, num_cols: Sequence[str], null_cols: Sequence[str]) -> DataFrame:
    """One aggregate pass -> long rows (pair_id, side, col, n_rows, col_sum, col_exact, n_null, is_numeric).

    A row with ``col`` null carries the row count even for tables without
    shared columns. ``col_exact`` is the exact sum of an integer or decimal
    column as text, ``col_sum`` the same in double precision. The aggregate
    and the unpivot are each one SQL projection (``selectExpr``), built as text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = ["count(1) AS __n"]
    aggs += [f"sum(try_cast({_bq(c)} AS DOUBLE)) AS __s{i}" for i, c in enumerate(num_cols)]
    aggs += [f"{_exact_sum(c, types[c])} AS __e{i}" for i, c in enumerate(num_cols)]
    aggs += [f"count_if({_bq(c)} IS NULL) AS __z{i}" for i, c in enumerate(null_cols)]
    one = df.selectExpr(*aggs)
    num_index = {c: i for i, c in enumerate(num_cols)}
    entries = ["named_struct('col', CAST(NULL AS STRING), 'col_sum', CAST(NULL AS DOUBLE), 'col_exact', CAST(NULL AS STRING), 'n_null', CAST(NULL AS BIGINT), 'is_numeric', false)"]
    for i, c in enumerate(null_cols):
        j = num_index.get(c)
        s_expr = f"__s{j}" if j is not None else "CAST(NULL AS DOUBLE)"
        e_expr = f"__e{j}" if j is not None else "CAST(NULL AS STRING)"
        entries.append(
            f"named_struct('col', {_sq(c)}, 'col_sum', {s_expr}, 'col_exact', {e_expr}, 'n_null', CAST(__z{i} AS BIGINT), 'is_numeric', {str(j is not None).lower()})"
        )
    return one.selectExpr(
        f"{_sq(pair_id)} AS pair_id", f"{_sq(side)} AS side", "__n AS n_rows", f"inline(array({', '.join(entries)}))"
    )


def type_text(dt: T.DataType) -> str:
    """A type as text, nested nullability included (top-level nullability is not part of a type).

    ``array<int>`` vs ``array<int NOT NULL>``: element, map-value and nested
    field nullability count, as they do in the type string the original
    compares.
    """
    if isinstance(dt, T.ArrayType):
        return f"array<{type_text(dt.elementType)}{'' if dt.containsNull else ' NOT NULL'}>"
    if isinstance(dt, T.MapType):
        return f"map<{type_text(dt.keyType)},{type_text(dt.valueType)}{'' if dt.valueContainsNull else ' NOT NULL'}>"
    if isinstance(dt, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{type_text(f.dataType)}{'' if f.nullable else ' NOT NULL'}" for f in dt.fields) + ">"
    return dt.simpleString()


def schema_rows(pair_id: str, side: str, df: DataFrame) -> list[tuple[str, str, str, str]]:
    """Schema facts (metadata only, no scan)."""
    return [(pair_id, side, f.name, type_text(f.dataType)) for f in df.schema.fields]


# Pairs profiled per job: each group is one plan of 2 x PROFILE_GROUP aggregates.
PROFILE_GROUP = 32
# Jobs of a fleet that run at the same time.
IN_FLIGHT = 4
PROFILE_SCHEMA = "pair_id string, side string, n_rows long, col string, col_sum double, col_exact string, n_null long, is_numeric boolean"
SIDE_SCHEMA = "pair_id string, side string, col string, col_type string"


def _both_sides(p: TablePair) -> list[DataFrame]:
    shared, nums = shared_columns(p.baseline, p.target), numeric_columns(p.baseline, p.target)
    return [side_profile(p.baseline, p.pair_id, "baseline", nums, shared), side_profile(p.target, p.pair_id, "target", nums, shared)]


def _pair_folder(state_dir: str, p: TablePair) -> str:
    """The folder of a pair's profile: by its id and what it compares, so a changed pair is profiled anew."""
    said = json.dumps([p.pair_id, p.baseline.schema.json(), p.target.schema.json(), sorted(p.baseline.inputFiles()), sorted(p.target.inputFiles())])
    return f"{state_dir.rstrip('/')}/profile={hashlib.sha256(said.encode()).hexdigest()[:32]}"


def pair_profiles(pairs: Iterable[TablePair], materialize: bool = True, in_flight: int = IN_FLIGHT, state_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Profiles and schemas of all validated pairs (skip rule applied to the config list).

    Each side is one aggregate (one scan). With ``materialize`` (default) the
    pairs are profiled in groups of :data:`PROFILE_GROUP`, ``in_flight`` groups
    at a time, each in a scheduler pool of its own (fair where the session's
    scheduler is): a group's plan is built when its turn comes, its union is
    written into one parquet folder in the shared folder, and all folders are
    read back as one table. A fleet of thousands of pairs neither builds one
    giant plan nor waits for one pair after the other.

    With ``state_dir`` (a shared folder) every pair is a job of its own whose
    profile stays there under its id, schemas and input files: a restarted
    validation reads the finished pairs and profiles only the others.
    """
    spark = SparkSession.active()
    todo = [p for p in pairs if p.target_status == "SUCCEEDED"]
    if not todo:  # every pair skipped, or none given
        return spark.createDataFrame([], PROFILE_SCHEMA), spark.createDataFrame([], SIDE_SCHEMA)
    schema = [r for p in todo for r in (*schema_rows(p.pair_id, "baseline", p.baseline), *schema_rows(p.pair_id, "target", p.target))]
    sch = spark.createDataFrame(schema, SIDE_SCHEMA)

    def union(group: list[TablePair]) -> DataFrame:
        return reduce(DataFrame.unionByName, [side for p in group for side in _both_sides(p)])

    if not materialize:
        return union(todo), sch
    if state_dir:
        jobs = [(_pair_folder(state_dir, p), [p]) for p in todo]
        waiting = [(path, group) for path, group in jobs if not path_exists(spark, f"{path}/_SUCCESS")]
    else:
        base = materialize_path(spark)
        jobs = waiting = [(f"{base}/group={g}", todo[g : g + PROFILE_GROUP]) for g in range(0, len(todo), PROFILE_GROUP)]

    def work(k: int) -> None:
        path, group = waiting[k]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fleet-{k % in_flight}")
        union(group).coalesce(1).write.mode("overwrite").parquet(path)

    with ThreadPoolExecutor(max_workers=in_flight) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(work), k) for k in range(len(waiting))]:
            done.result()
    return spark.read.schema(PROFILE_SCHEMA).parquet(*dict.fromkeys(path for path, _ in jobs)), sch


def check_specs(pairs_df: DataFrame, checks_json_col: Column) -> DataFrame:
    """Spec list -> rows (pair_id, check_no, name, type, severity, tolerance).

    Severity defaults to ``warning`` and ``config.tolerance`` to 0.0001.
    """
    specs = pairs_df.select("pair_id", F.posexplode(F.from_json(checks_json_col, CHECK_SPEC_TYPE)).alias("check_no", "spec"))
    return specs.select(
        "pair_id",
        (F.col("check_no") + 1).alias("check_no"),
        F.col("spec.name").alias("name"),
        F.col("spec.type").alias("type"),
        F.coalesce(F.col("spec.severity"), F.lit(DEFAULT_SEVERITY)).alias("severity"),
        F.coalesce(
            F.col("spec.config").getItem("tolerance").try_cast("double"), F.lit(DEFAULT_TOLERANCE)
        ).alias("tolerance"),
    )


def _sides(prof: DataFrame) -> DataFrame:
    """Baseline and target values of each column side by side (one aggregate, no join)."""
    is_b, is_t = F.col("side") == "baseline", F.col("side") == "target"
    return (
        prof.filter(F.col("col").isNotNull())
        .groupBy("pair_id", "col")
        .agg(
            F.count_if(is_b).alias("__nb"),
            F.count_if(is_t).alias("__nt"),
            F.bool_or(F.col("is_numeric")).alias("is_numeric"),
            F.max(F.when(is_b, F.coalesce("col_sum", F.lit(0.0)))).alias("baseline_sum"),
            F.max(F.when(is_t, F.coalesce("col_sum", F.lit(0.0)))).alias("target_sum"),
            F.max(F.when(is_b, F.col("col_exact"))).alias("baseline_exact"),
            F.max(F.when(is_t, F.col("col_exact"))).alias("target_exact"),
            F.max(F.when(is_b, F.col("n_null"))).alias("baseline_nulls"),
            F.max(F.when(is_t, F.col("n_null"))).alias("target_nulls"),
        )
        .filter((F.col("__nb") > 0) & (F.col("__nt") > 0))
        .drop("__nb", "__nt")
    )


def _plain(text: Column) -> Column:
    """Decimal text without trailing zeros behind the point, so that 5 and 5.00 are the same."""
    cut = F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1")
    cut = F.regexp_replace(cut, r"\.$", "")
    return F.when(cut == "-0", "0").otherwise(cut)


def _relative_diff(bs: Column, ts: Column) -> Column:
    """|t - b| / |b|. Exact sums that differ never give 0, however close they are in double precision; equal ones always do."""
    b, t = _plain(F.col("baseline_exact")), _plain(F.col("target_exact"))
    exact = b.isNotNull() & t.isNotNull()
    near = (
        F.when(F.isnan(bs) | F.isnan(ts), F.lit(None).cast("double"))
        .when(bs == 0, F.when(ts == 0, F.lit(0.0)).otherwise(F.lit(float("inf"))))
        .otherwise(F.try_divide(F.abs(ts - bs), F.abs(bs)))
    )
    return F.when(exact & (b == t), F.lit(0.0)).when(exact, F.greatest(near, F.lit(5e-324))).otherwise(near)


def column_sums(prof: DataFrame) -> DataFrame:
    """Numeric columns side by side with the relative difference (P4 arithmetic).

    rel = 0 when both sums are 0, +inf when only the baseline is 0, else
    |t - b| / |b|; a null (all-null) sum counts as 0.
    """
    bs, ts = F.col("baseline_sum"), F.col("target_sum")
    return _sides(prof).filter("is_numeric").select(
        "pair_id", "col", "baseline_sum", "target_sum",
        _relative_diff(bs, ts).alias("relative_diff"),
        (F.isnan(bs) != F.isnan(ts)).alias("nan_differs"),
    )


def null_counts(prof: DataFrame) -> DataFrame:
    return _sides(prof).select("pair_id", "col", "baseline_nulls", "target_nulls")


def _pair_facts(prof: DataFrame, sch: DataFrame) -> DataFrame:
    """Per pair: row counts, numeric sums, schema set difference, null-count differences."""
    counts = prof.filter(F.col("col").isNull()).groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == "baseline", F.col("n_rows"))).alias("baseline_rows"),
        F.max(F.when(F.col("side") == "target", F.col("n_rows"))).alias("target_rows"),
    )
    bs, ts = F.col("baseline_sum"), F.col("target_sum")
    cols = _sides(prof).groupBy("pair_id").agg(
        F.collect_list(
            F.when(
                F.col("is_numeric"),
                F.struct(
                    F.col("col"),
                    _relative_diff(bs, ts).alias("rel"),
                    (F.isnan(bs) != F.isnan(ts)).alias("nan_differs"),
                ),
            )
        ).alias("numeric"),
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("baseline_nulls") != F.col("target_nulls"),
                    F.struct("col", F.struct("baseline_nulls", "target_nulls").alias("v")),
                )
            )
        ).alias("null_diffs"),
    )
    field = F.concat_ws(":", "col", "col_type")
    schema = sch.groupBy("pair_id").agg(
        F.collect_set(F.when(F.col("side") == "baseline", field)).alias("bf"),
        F.collect_set(F.when(F.col("side") == "target", field)).alias("tf"),
    ).select(
        "pair_id",
        F.array_sort(F.array_except("bf", "tf")).alias("missing_in_target"),
        F.array_sort(F.array_except("tf", "bf")).alias("added_in_target"),
    )
    # small tables read from a written profile: the planner broadcasts them by their measured size
    return counts.join(cols, "pair_id", "left").join(schema, "pair_id", "left")


# --- check registry (P6) ------------------------------------------------------------------
#
# A check is a function of the per-pair fact columns available to every spec
# row -- baseline_rows, target_rows, missing_in_target, added_in_target,
# null_diffs, numeric (col, rel, nan_differs), diff_cols (numeric columns
# beyond the spec's tolerance), n_numeric, severity, tolerance -- returning
# (status, details) columns. Names not in the registry give FAILED
# "Unknown check type: <name>".

CheckBuilder = Callable[[], tuple[Column, Column]]
CHECKS: dict[str, CheckBuilder] = {}


def register_check(name: str):
    """Decorator: add a check to the registry under ``name``."""

    def deco(fn: CheckBuilder) -> CheckBuilder:
        CHECKS[name] = fn
        return fn

    return deco


def _soft_fail() -> Column:
    """FAILED for a critical check, else WARNING."""
    return F.when(F.col("severity") == "critical", "FAILED").otherwise("WARNING")


@register_check(CHECK_ROW_COUNT)
def _row_count() -> tuple[Column, Column]:
    same = F.col("baseline_rows") == F.col("target_rows")
    return (
        F.when(same, "PASSED").otherwise("FAILED"),
        F.when(same, F.format_string("%d rows in both", "baseline_rows")).otherwise(
            F.format_string("baseline=%d target=%d", "baseline_rows", "target_rows")
        ),
    )


@register_check(CHECK_SCHEMA)
def _schema() -> tuple[Column, Column]:
    same = (F.size("missing_in_target") == 0) & (F.size("added_in_target") == 0)
    return (
        F.when(same, "PASSED").otherwise("FAILED"),
        F.when(same, F.lit("schemas identical")).otherwise(
            F.concat(F.lit("missing_in_target="), F.to_json("missing_in_target"), F.lit(" added_in_target="), F.to_json("added_in_target"))
        ),
    )


@register_check(CHECK_COLUMN_DIFF)
def _column_diff() -> tuple[Column, Column]:
    differs = F.size("diff_cols") > 0
    return (
        F.when(differs, _soft_fail()).otherwise("PASSED"),
        F.when(F.col("n_numeric") == 0, F.lit("no numeric columns to compare"))
        .when(differs, F.concat(F.lit("columns differ beyond tolerance: "), F.to_json("diff_cols")))
        .otherwise(F.lit("all numeric columns within tolerance")),
    )


@register_check(CHECK_NULL_COUNT)
def _null_count() -> tuple[Column, Column]:
    differs = F.coalesce(F.size("null_diffs"), F.lit(0)) > 0
    return (
        F.when(differs, _soft_fail()).otherwise("PASSED"),
        F.when(differs, F.concat(F.lit("null count differences: "), F.to_json(F.map_from_entries("null_diffs")))).otherwise(
            F.lit("null counts match")
        ),
    )


def run_checks(prof: DataFrame, sch: DataFrame, specs: DataFrame) -> DataFrame:
    """One result row per (pair, spec) in spec order, dispatched by check name.

    Columns: pair_id, check_no, name, status, severity, details.
    """
    r = specs.join(_pair_facts(prof, sch), "pair_id", "left")
    numeric = F.coalesce(F.col("numeric"), F.array())
    diff_cols = F.array_sort(
        F.transform(
            F.filter(numeric, lambda x: x["nan_differs"] | (x["rel"] > F.col("tolerance"))),
            lambda x: x["col"],
        )
    )
    r = r.withColumn("diff_cols", diff_cols).withColumn("n_numeric", F.size(numeric))
    name = F.col("name")
    status = details = None
    for check_name, build in CHECKS.items():
        st, de = build()
        status = F.when(name == check_name, st) if status is None else status.when(name == check_name, st)
        details = F.when(name == check_name, de) if details is None else details.when(name == check_name, de)
    status = status.otherwise("FAILED")
    details = details.otherwise(F.concat(F.lit("Unknown check type: "), F.coalesce(name, F.lit("None"))))
    return r.select("pair_id", "check_no", "name", status.alias("status"), F.col("severity"), details.alias("details"))


def schema_diff(sch: DataFrame) -> DataFrame:
    """P2 on its own: per pair the (name:type) fields missing in the target and added in it."""
    field = F.concat_ws(":", "col", "col_type")
    return sch.groupBy("pair_id").agg(
        F.collect_set(F.when(F.col("side") == "baseline", field)).alias("bf"),
        F.collect_set(F.when(F.col("side") == "target", field)).alias("tf"),
    ).select(
        "pair_id",
        F.array_sort(F.array_except("bf", "tf")).alias("missing_in_target"),
        F.array_sort(F.array_except("tf", "bf")).alias("added_in_target"),
    )


def fleet_report(overall: DataFrame) -> DataFrame:
    """P14 aggregate report: pairs and failing checks per overall status."""
    return overall.groupBy("overall_status").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum("n_not_passed").alias("n_checks_not_passed"),
        F.array_join(F.array_sort(F.collect_list("pair_id")), ",").alias("pairs"),
    )


def overall_status(results: DataFrame, pairs_df: DataFrame) -> DataFrame:
    """P8 + P11: FAILED if any critical FAILED, else WARNING if any FAILED/WARNING,
    else PASSED (also with no checks); pairs whose target did not succeed are SKIPPED."""
    roll = results.groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.bool_or((F.col("status") == "FAILED") & (F.col("severity") == "critical")).alias("crit"),
        F.bool_or(F.col("status").isin("FAILED", "WARNING")).alias("soft"),
        F.count_if(F.col("status") != "PASSED").alias("n_not_passed"),
    )
    j = pairs_df.select("pair_id", "target_status").join(roll, "pair_id", "left")
    st = (
        F.when(F.col("target_status") != "SUCCEEDED", "SKIPPED")
        .when(F.coalesce("crit", F.lit(False)), "FAILED")
        .when(F.coalesce("soft", F.lit(False)), "WARNING")
        .otherwise("PASSED")
    )
    return j.select(
        "pair_id",
        st.alias("overall_status"),
        F.coalesce("n_checks", F.lit(0)).alias("n_checks"),
        F.coalesce("n_not_passed", F.lit(0)).alias("n_not_passed"),
    )


def pairs_table(spark: SparkSession, pairs: Sequence[TablePair], checks_json: str = DEFAULT_CHECKS_JSON) -> DataFrame:
    rows = [(p.pair_id, p.target_status, p.checks_json or checks_json) for p in pairs]
    return spark.createDataFrame(rows, "pair_id string, target_status string, checks_json string")


def validate(pairs: Sequence[TablePair], checks_json: str = DEFAULT_CHECKS_JSON, in_flight: int = IN_FLIGHT, state_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The parity suite over one or many pairs.

    Returns (check results, overall status per pair). ``in_flight`` and
    ``state_dir`` are those of :func:`pair_profiles`.
    """
    spark = SparkSession.active()
    pdf = pairs_table(spark, pairs, checks_json)
    prof, sch = pair_profiles(pairs, in_flight=in_flight, state_dir=state_dir)
    specs = check_specs(pdf.filter(F.col("target_status") == "SUCCEEDED"), F.col("checks_json"))
    results = run_checks(prof, sch, specs)
    return results, overall_status(results, pdf)


def column_profile(df: DataFrame, pair_id: str, side: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Count / null count / sum / avg / min / max of every numeric column, one pass.

    Returns long rows (pair_id, side, col, n, n_null, col_sum, col_avg, col_min, col_max).
    """
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_SCALARS)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [
            F.count_if(_q(c).isNull()).alias(f"__z{i}"),
            F.sum(x).alias(f"__s{i}"),
            F.avg(x).alias(f"__a{i}"),
            F.min(x).alias(f"__lo{i}"),
            F.max(x).alias(f"__hi{i}"),
        ]
    one = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("col"),
            F.col(f"__z{i}").cast("long").alias("n_null"),
            F.col(f"__s{i}").alias("col_sum"),
            F.col(f"__a{i}").alias("col_avg"),
            F.col(f"__lo{i}").alias("col_min"),
            F.col(f"__hi{i}").alias("col_max"),
        )
        for i, c in enumerate(cols)
    ]
    return one.select(F.lit(pair_id).alias("pair_id"), F.lit(side).alias("side"), F.col("__n").alias("n"), F.inline(F.array(*entries)))


# Copies of one differing row are generated in chunks of this size, so no
# generated array grows with a row's multiplicity.
REPLICATE_CHUNK = 10_000


def multiset_diff(baseline: DataFrame, target: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``baseline`` not matched in ``target`` and vice versa, with multiplicity.

    Both directions of ``exceptAll`` from one aggregation: each distinct row
    is counted per side (null-safe grouping; partial aggregation collapses a
    row repeated a third of the time), and |nb - nt| copies are emitted with
    ``diff_side`` missing_in_target / added_in_target.
    """
    cols = list(cols)
    b = baseline.select(*[_q(c) for c in cols], F.lit(1).alias("__b"), F.lit(0).alias("__t"))
    t = target.select(*[_q(c) for c in cols], F.lit(0).alias("__b"), F.lit(1).alias("__t"))
    g = (
        b.unionByName(t)
        .groupBy(*[_q(c) for c in cols])
        .agg(F.sum("__b").alias("__nb"), F.sum("__t").alias("__nt"))
        .filter(F.col("__nb") != F.col("__nt"))
    )
    n = F.abs(F.col("__nb") - F.col("__nt"))
    side = F.when(F.col("__nb") > F.col("__nt"), "missing_in_target").otherwise("added_in_target")
    chunks = g.select(*[_q(c) for c in cols], side.alias("diff_side"), n.alias("__n"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / REPLICATE_CHUNK).cast("long"))
    ).alias("__c"))
    rep = F.least(F.lit(REPLICATE_CHUNK).cast("long"), F.col("__n") - F.col("__c") * REPLICATE_CHUNK)
    return chunks.select(*[_q(c) for c in cols], "diff_side", F.explode(F.array_repeat(F.lit(True), rep.cast("int"))).alias("__x")).drop("__x")


def row_diff_except(baseline: DataFrame, target: DataFrame) -> DataFrame:
    """P13 (multiset form): rows only in baseline and rows only in target (duplicates kept).

    One aggregation over both sides (each side scanned once), see
    :func:`multiset_diff`.
    """
    return multiset_diff(baseline, target, shared_columns(baseline, target))


def lossless(c: Column, dt: T.DataType) -> Column:
    """A value as structs and arrays in which equal hashes or comparisons mean equal values.

    Nulls carry a flag (a hash skips them), arrays their size, maps become
    entries sorted by key; at any depth.
    """
    if isinstance(dt, T.ArrayType):
        return F.struct(c.isNull().alias("n"), F.size(c).alias("s"), F.transform(c, lambda x: lossless(x, dt.elementType)).alias("v"))
    if isinstance(dt, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(lossless(e["key"], dt.keyType).alias("k"), lossless(e["value"], dt.valueType).alias("v")))
        return F.struct(c.isNull().alias("n"), F.size(c).alias("s"), F.array_sort(entries).alias("v"))
    if isinstance(dt, T.StructType):
        return F.struct(c.isNull().alias("n"), *[lossless(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dt.fields)])
    return F.struct(c.isNull().alias("n"), c.alias("v"))


def _same_types(baseline: DataFrame, target: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``cols`` in common types (the wider one; text where there is none)."""
    casts = {}
    left, right = {f.name: f.dataType for f in baseline.schema.fields}, {f.name: f.dataType for f in target.schema.fields}
    for c in cols:
        if left[c].simpleString() != right[c].simpleString():
            try:
                casts[c] = baseline.select(_q(c)).union(target.select(_q(c))).schema[0].dataType
            except AnalysisException:
                casts[c] = T.StringType()
    pick = lambda df: df.select(*[_q(c).cast(casts[c]).alias(c) if c in casts else _q(c) for c in cols])
    return pick(baseline), pick(target)


def row_diff_keyed(baseline: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P13 (keyed form): rows that differ between two tables keyed by ``keys``.

    Returns (keys..., diff_kind, changed_cols):
      * a key present exactly once on each side whose rows differ gives one
        ``changed`` row listing the differing columns (null-safe compare);
      * every other key (absent on one side, or repeated on either side) is
        compared as a multiset: each baseline row without an equal target row
        gives ``only_baseline``, each target row without an equal baseline
        row gives ``only_target`` (changed_cols empty).

    Rows are compared by two 64-bit hashes of their typed values
    (:func:`lossless`): full timestamp precision, decimals, binaries, nested
    values and maps. No key group is ever paired with itself, so a key holding
    a third of all rows costs no quadratic join. Plan: one hash aggregate over
    the key (only key and digests are shuffled, hot keys collapse before it)
    finds the keys whose rows differ, by counts and by the signed sums of the
    digests of both sides, and writes them once. One more pass per side takes
    the digests of those that repeat or are on one side alone, another the whole rows of
    those present once on each side; rows of equal keys go no further.
    """
    keys = list(keys)
    cols = [c for c in shared_columns(baseline, target) if c not in keys]
    baseline, target = _same_types(baseline, target, keys + cols)
    values = [lossless(_q(f.name), f.dataType) for f in baseline.schema.fields if f.name not in keys]
    digests = [F.xxhash64(F.lit(salt), *values).alias(name) for name, salt in (("__d1", 1), ("__d2", 2))]

    def tagged(df: DataFrame, sign: int) -> DataFrame:
        # halves of 32 bits: their sums are zero if the digests of both sides are the same ones; beyond 2^31 rows of a key
        # a sum may be null, and the key is compared row by row
        d = df.select(*[_q(k) for k in keys], *digests)
        halves = [(F.shiftright(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF))) for x in (F.col("__d1"), F.col("__d2"))]
        return d.select(*[_q(k) for k in keys], F.lit(sign).cast("long").alias("__n"), *[(F.lit(sign) * x).alias(f"__s{i}") for i, x in enumerate(y for h in halves for y in h)])

    sums = [F.try_sum(f"__s{i}").alias(f"__s{i}") for i in range(4)]
    per_key = tagged(baseline, 1).unionByName(tagged(target, -1)).groupBy(*[_q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum("__n").alias("__n"), *sums
    )
    differ = F.col("__n") != 0
    for i in range(4):
        differ = differ | F.coalesce(F.col(f"__s{i}") != 0, F.lit(True))
    single = (F.col("__rows") == 2) & (F.col("__n") == 0)
    cls = cut_lineage(per_key.filter(differ).select(*[_q(k) for k in keys], F.when(single, F.lit("pair")).otherwise(F.lit("multi")).alias("__cls")))

    def fetch(df: DataFrame, kind: str) -> DataFrame:
        # the rows of ``df`` whose key is of that kind; cls carries size stats: the planner broadcasts it when small
        d, c = df.alias("__d"), cls.filter(F.col("__cls") == kind).alias("__c")
        cond = None
        for k in keys:
            e = F.col(f"__d.{_bq(k)}").eqNullSafe(F.col(f"__c.{_bq(k)}"))
            cond = e if cond is None else cond & e
        return d.join(c, cond, "left_semi")

    changed = _keyed_compare(fetch(baseline, "pair"), fetch(target, "pair"), keys, cols)
    empty = F.array().cast("array<string>")
    multi = [fetch(df.select(*[_q(k) for k in keys], *digests), "multi") for df in (baseline, target)]
    only = multiset_diff(*multi, [*keys, "__d1", "__d2"]).select(
        *[_q(k) for k in keys],
        F.when(F.col("diff_side") == "missing_in_target", "only_baseline").otherwise("only_target").alias("diff_kind"),
        empty.alias("changed_cols"),
    )
    return changed.unionByName(only)


def _keyed_compare(baseline: DataFrame, target: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The differing columns of keys present once on each side."""
    types = {f.name: f.dataType for f in baseline.schema.fields}
    side = lambda df, p: df.select(*[_q(k).alias(f"{p}k{i}") for i, k in enumerate(keys)], *[lossless(_q(c), types[c]).alias(f"{p}{i}") for i, c in enumerate(cols)])
    b, t = side(baseline, "__b"), side(target, "__t")
    cond = None
    for i in range(len(keys)):
        e = F.col(f"__bk{i}").eqNullSafe(F.col(f"__tk{i}"))
        cond = e if cond is None else cond & e
    named = sorted((c, i) for i, c in enumerate(cols))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__b{i}").eqNullSafe(F.col(f"__t{i}")), F.lit(c)) for c, i in named]))
    return b.join(t, cond).select(*[F.col(f"__bk{i}").alias(k) for i, k in enumerate(keys)], F.lit("changed").alias("diff_kind"), changed.alias("changed_cols"))


def validation_effects(results: DataFrame, overall: DataFrame) -> DataFrame:
    """Record updates and events the validation step writes, per pair (run).

    Rows (pair_id, record_type in {pipeline, metadata, event}, field, value):
    a validated pair stores its results document and status on the pipeline
    record, a ``validation_completed`` event, and phase REPORT plus the
    overall status on the run; a skipped pair (target did not succeed) only
    gets a ``validation_skipped`` event with reason target_not_succeeded.
    """
    checks = results.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.struct("check_no", "name", "status", "details", "severity"))).alias("checks")
    )
    j = overall.select("pair_id", "overall_status").join(checks, "pair_id", "left")
    st = F.col("overall_status")
    skipped = st == "SKIPPED"
    doc = F.to_json(F.struct(st.alias("overall_status"), F.transform(
        F.coalesce(F.col("checks"), F.array()), lambda c: F.struct(c["name"].alias("name"), c["status"].alias("status"), c["details"].alias("details"), c["severity"].alias("severity"))
    ).alias("checks")))
    C = lambda rec, field, cond, value: F.when(cond, F.struct(F.lit(rec).alias("record_type"), F.lit(field).alias("field"), value.cast("string").alias("value")))
    rows = F.array_compact(F.array(
        C("pipeline", "validation_results", ~skipped, doc),
        C("pipeline", "status", ~skipped, st),
        C("event", "validation_completed", ~skipped, F.concat(F.lit("overall_status="), st)),
        C("event", "validation_skipped", skipped, F.lit("reason=target_not_succeeded")),
        C("metadata", "phase", F.lit(True), F.lit("REPORT")),
        C("metadata", "overall_status", ~skipped, st),
        C("metadata", "status", ~skipped, st),
    ))
    return j.select("pair_id", F.explode(rows).alias("c")).select("pair_id", "c.record_type", "c.field", "c.value")
