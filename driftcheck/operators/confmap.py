"""Configuration maps as columns.

All operators are per-row map/array expressions (JVM higher-order
functions), so they scale with the table like a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
ANSI_KEY = "spark.sql.ansi.enabled"
UNSUPPORTED_KEYS = ["spark.master"]


def empty_conf() -> Column:
    return F.create_map().cast("map<string,string>")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def overlay(base: Column | str, override: Column | str) -> Column:
    """Keys of ``override`` replace those of ``base``; a missing override means base only.

    ``map_concat`` would raise DUPLICATED_MAP_KEY, so the merge is a
    ``map_zip_with`` over the union of keys.
    """
    b = F.coalesce(_c(base), empty_conf())
    o = _c(override)
    merged = F.map_zip_with(b, F.coalesce(o, empty_conf()), lambda k, x, y: F.when(F.map_contains_key(o, k), y).otherwise(x))
    return F.when(o.isNull(), b).otherwise(merged)


def strip_keys(conf: Column | str, keys: list[str] = UNSUPPORTED_KEYS) -> Column:
    """Drop unsupported keys."""
    bad = F.array(*[F.lit(k) for k in keys])
    return F.map_filter(_c(conf), lambda k, v: ~F.array_contains(bad, k))


def default_ansi(conf: Column | str, spark_version: Column | str) -> Column:
    """For a 4.x version without the key, add spark.sql.ansi.enabled=true."""
    m = _c(conf)
    need = _c(spark_version).startswith("4.") & ~F.map_contains_key(m, ANSI_KEY)
    return F.when(need, F.map_concat(m, F.create_map(F.lit(ANSI_KEY), F.lit("true")))).otherwise(m)


def effective_conf(manifest_conf: Column | str, branch_conf: Column | str, spark_version: Column | str) -> Column:
    """C1 -> C3 -> C2, in the order the submit step applies them."""
    return default_ansi(strip_keys(overlay(manifest_conf, branch_conf)), spark_version)


def set_key(conf: Column | str, key: Column | str, value: Column | str) -> Column:
    """Set one key; other keys kept; a missing map is created."""
    return overlay(_c(conf), F.create_map(_c(key), _c(value)))


def conf_text(conf: Column | str) -> Column:
    """Deterministic text of a map: sorted ``key=value`` entries joined by ``;``."""
    return F.array_join(
        F.array_sort(F.transform(F.map_entries(_c(conf)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";"
    )


def apply_changes(text: Column | str, changes: Column | str) -> Column:
    """For each change in order replace every ``from_value`` by ``to_value`` (``key`` ignored)."""
    return F.aggregate(_c(changes), _c(text), lambda acc, c: F.replace(acc, c["from_value"], c["to_value"]))


# --- C8: manifest conformance -------------------------------------------------------------

# Validation messages.
MSG_REQUIRED = "Field required"
MSG_ACTION = "Input should be 'config_fix', 'code_change' or 'escalate'"
MSG_CHECK_TYPE = "Input should be 'exact' or 'tolerance'"
MSG_SEVERITY = "Input should be 'critical', 'warning' or 'info'"
MSG_FALSE = "Input should be False"
MSG_PROVIDER = "Input should be 'github'"
MSG_OBJECT = "Input should be a valid dictionary"
MSG_MODEL = "Input should be a valid dictionary or instance of {}"
MSG_LIST = "Input should be a valid list"
MSG_STR = "Input should be a valid string"
MSG_INT = "Input should be a valid integer"
MSG_INT_PARSE = "Input should be a valid integer, unable to parse string as an integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_BOOL = "Input should be a valid boolean"
MSG_BOOL_PARSE = "Input should be a valid boolean, unable to interpret input"
BOOL_WORDS = ["0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes"]

_S = T.StringType()


def _st(*names: str, **nested: T.DataType) -> T.StructType:
    fields = [T.StructField(n, _S) for n in names]
    fields += [T.StructField(k, v) for k, v in nested.items()]
    return T.StructType(fields)


MANIFEST_SCHEMA = _st(
    test=_st("name", "description", "owner"),
    source_control=_st(
        "provider", "owner", "repo",
        baseline=_st("branch"),
        target=_st("branch_prefix"),
        pr=_st("auto_merge"),
    ),
    pipeline=_st("id", "entry_script"),
    execution=_st("output_base", "baseline_spark_version", "target_spark_version", timeouts=_st("single_pipeline_seconds")),
    log_analysis=T.StructType(
        [
            T.StructField("known_failure_patterns", T.ArrayType(_st("pattern", "diagnosis", "action", "auto_fix"))),
            T.StructField("retry", _st("max_retries", "backoff_seconds")),
        ]
    ),
    validation=T.StructType([T.StructField("checks", T.ArrayType(_st("name", "type", "severity")))]),
    reporting=_st("output_dir"),
    upgrade_strategy=_st("type", version_mapping=_st("baseline", "target")),
)

# Required fields per section, in schema order (sections themselves are required).
_REQUIRED = [
    ("test", ["name", "description", "owner"]),
    ("source_control", ["owner", "repo", "baseline", "baseline.branch", "target", "target.branch_prefix", "pr"]),
    ("pipeline", ["id", "entry_script"]),
    ("execution", ["output_base", "baseline_spark_version", "target_spark_version", "timeouts", "timeouts.single_pipeline_seconds"]),
    ("log_analysis", ["retry", "retry.max_retries", "retry.backoff_seconds"]),
    ("validation", []),
    ("reporting", ["output_dir"]),
    ("upgrade_strategy", ["type", "version_mapping", "version_mapping.baseline", "version_mapping.target"]),
]


def type_error(x: Column, kind: str) -> Column:
    """Message for a present JSON value ``x`` (VARIANT) that does not coerce to ``kind``, else null.

    Lax coercion: an int takes integers, booleans, integral numbers and
    numeric text ("7", " 7 ", "7.0"); a bool takes booleans, 0/1 and the
    words in :data:`BOOL_WORDS` (any case); a str takes text only. An explicit
    null is a type error, not a missing field.
    """
    t = F.schema_of_variant(x)
    integral = t.isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    fractional = t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")
    num = F.try_variant_get(x, "$", "double")
    text = F.try_variant_get(x, "$", "string")
    none = F.lit(None).cast("string")
    if kind == "str":
        return F.when(t != "STRING", F.lit(MSG_STR)).otherwise(none)
    if kind == "int":
        return (
            F.when(integral | (t == "BOOLEAN"), none)
            .when(fractional, F.when(num != F.floor(num), F.lit(MSG_INT_FRACTION)).otherwise(none))
            .when(t == "STRING", F.when(text.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), none).otherwise(F.lit(MSG_INT_PARSE)))
            .otherwise(F.lit(MSG_INT))
        )
    return (
        F.when(t == "BOOLEAN", none)
        .when(integral, F.when(num.isin(0.0, 1.0), none).otherwise(F.lit(MSG_BOOL_PARSE)))
        .when(fractional, F.when(num.isin(0.0, 1.0), none).when(num == F.floor(num), F.lit(MSG_BOOL_PARSE)).otherwise(F.lit(MSG_BOOL)))
        .when(t == "STRING", F.when(F.lower(text).isin(*BOOL_WORDS), none).otherwise(F.lit(MSG_BOOL_PARSE)))
        .otherwise(F.lit(MSG_BOOL))
    )


def _missing(m: Column, path: str) -> Column:
    parts = path.split(".")
    c = m
    for p in parts:
        c = c[p]
    # a nested field is reported only when its parent exists
    parent_ok = F.lit(True)
    p = m
    for part in parts[:-1]:
        p = p[part]
        parent_ok = parent_ok & p.isNotNull()
    return F.when(parent_ok & c.isNull(), F.lit(f"{path}: {MSG_REQUIRED}"))


def manifest_errors(manifest: Column) -> Column:
    """C8 on a parsed struct: error text ``a.b.c: msg`` joined by ``; ``, or null when the manifest conforms.

    ``manifest`` is ``from_json(text, MANIFEST_SCHEMA)``. Checks: required
    sections and fields, provider, rule action, check type and severity
    enums, and ``pr.auto_merge`` must be false. Types are checked by
    :func:`parse_manifests`, which walks the text itself.
    """
    msgs: list[Column] = []
    for section, fields in _REQUIRED:
        sec = manifest[section]
        msgs.append(F.array(F.when(sec.isNull(), F.lit(f"{section}: {MSG_REQUIRED}"))))
        if section == "log_analysis":  # known_failure_patterns precedes retry
            msgs.append(_rule_errors(F.coalesce(sec["known_failure_patterns"], F.array())))
        if section == "validation":
            msgs.append(_check_errors(F.coalesce(sec["checks"], F.array())))
        if section == "source_control":  # provider (default github) is the first field
            pv = sec["provider"]
            msgs.append(F.array(F.when(pv.isNotNull() & (pv != "github"), F.lit(f"source_control.provider: {MSG_PROVIDER}"))))
        for f in fields:
            msgs.append(F.array(F.when(sec.isNotNull(), _missing(manifest, f"{section}.{f}"))))
        if section == "source_control":  # pr is the last field
            am = sec["pr"]["auto_merge"]
            msgs.append(F.array(F.when(am.isNotNull() & (F.lower(am) != "false"), F.lit(f"source_control.pr.auto_merge: {MSG_FALSE}"))))
    return _joined(F.concat(*msgs))


def _joined(messages: Column) -> Column:
    kept = F.array_compact(messages)
    return F.when(F.size(kept) > 0, F.array_join(kept, "; "))


# --- C8: the walk over a manifest of any shape ------------------------------------------------

@dataclass(frozen=True)
class Leaf:
    """A scalar: ``str``, ``int`` or ``bool`` by lax coercion, or one of ``allowed`` with its own message."""

    kind: str = "str"
    allowed: tuple = ()
    message: str = ""


@dataclass(frozen=True)
class Entries:
    """An object with any keys; with ``value``, each of its values is walked."""

    value: Leaf | None = None


@dataclass(frozen=True)
class Items:
    """A list, each element walked."""

    element: Leaf | Model


@dataclass(frozen=True)
class Model:
    """An object with named fields, in order: field -> (shape, required)."""

    name: str
    fields: dict


STR, INT, BOOL = Leaf("str"), Leaf("int"), Leaf("bool")


def _model(name: str, /, **fields) -> Model:
    """Fields are required; those given as a one-element list may be absent."""
    return Model(name, {f: (v[0], False) if isinstance(v, list) else (v, True) for f, v in fields.items()})


# Names, fields and their order, which messages and paths show.
MANIFEST = _model(
    "TestManifest",
    test=_model("TestInfo", name=STR, description=STR, owner=STR),
    source_control=_model(
        "SourceControlConfig",
        provider=[Leaf("str", ("github",), MSG_PROVIDER)], owner=STR, repo=STR,
        baseline=_model("BranchConfig", branch=STR),
        target=_model(
            "TargetBranchConfig",
            branch_prefix=STR,
            modifications=[Items(_model("FileModification", file=STR, changes=Items(_model("FileChange", key=STR, from_value=STR, to_value=STR))))],
        ),
        pr=_model("PullRequestConfig", reviewers=[Items(STR)], auto_create=[BOOL], auto_merge=[Leaf("bool", (False,), MSG_FALSE)]),
    ),
    pipeline=_model("PipelineConfig", id=STR, entry_script=STR, spark_config=[Entries(STR)]),
    execution=_model(
        "ExecutionConfig",
        output_base=STR, baseline_spark_version=STR, target_spark_version=STR,
        timeouts=_model("TimeoutConfig", single_pipeline_seconds=INT),
    ),
    log_analysis=_model(
        "LogAnalysisConfig",
        known_failure_patterns=[Items(_model(
            "KnownFailurePattern",
            pattern=STR, diagnosis=STR, action=Leaf("str", ("config_fix", "code_change", "escalate"), MSG_ACTION), auto_fix=BOOL,
            fix_config=[_model("FixConfig", key=STR, value=STR)],
        ))],
        retry=_model("RetryConfig", max_retries=INT, backoff_seconds=INT),
    ),
    validation=_model(
        "ValidationConfig",
        checks=[Items(_model(
            "ValidationCheck",
            name=STR, type=Leaf("str", ("exact", "tolerance"), MSG_CHECK_TYPE), severity=Leaf("str", ("critical", "warning", "info"), MSG_SEVERITY),
            config=[Entries()],
        ))],
    ),
    reporting=_model("ReportingConfig", output_dir=STR, formats=[Items(STR)]),
    upgrade_strategy=_model(
        "UpgradeStrategyConfig",
        type=STR, version_mapping=_model("VersionMapping", baseline=Entries(STR), target=Entries(STR)), migration_notes=[Items(STR)],
    ),
)
#: Fields whose explicit null is a value like any other.
NULLABLE = {"fix_config"}


def walk(x: Column, shape: Leaf | Entries | Items | Model, label: Column | None = None) -> Column:
    """array<string> of ``path: message`` for the VARIANT ``x``, in the order of the fields.

    The value is present (an explicit null counts as one). A value of another
    type gives one message and is not entered; elements of a list are
    labelled by position, entries of an object by key (in key order, which
    is how a VARIANT keeps them). Each object and list is opened once, as a
    map or an array of its values, and its fields are looked up there: a path
    from the root for every field would search all objects above it again.
    """
    path = F.lit("") if label is None else label
    fail = lambda msg: F.array(F.concat(path, F.lit(f": {msg}")))
    child = lambda name: name if label is None else F.concat(label, F.lit("."), name)
    if isinstance(shape, Leaf):
        if not shape.allowed:
            return F.array(F.concat(path, F.lit(": "), type_error(x, shape.kind)))
        typed = "STRING" if shape.kind == "str" else "BOOLEAN"
        value = F.try_variant_get(x, "$", "string" if shape.kind == "str" else "boolean")
        return F.when((F.schema_of_variant(x) != typed) | ~value.isin(*shape.allowed), fail(shape.message))
    if isinstance(shape, Items):
        element = lambda e, i: _present(walk(e, shape.element, child(i.cast("string"))))
        return _opened(x, "array<variant>", lambda found: F.when(found.isNull(), fail(MSG_LIST)).otherwise(F.flatten(F.transform(found, element))))
    if isinstance(shape, Entries):
        entry = lambda e: _present(walk(e["value"], shape.value, child(e["key"])))
        each = lambda found: F.flatten(F.transform(F.map_entries(found), entry)) if shape.value is not None else F.lit(None).cast("array<string>")
        return _opened(x, "map<string,variant>", lambda found: F.when(found.isNull(), fail(MSG_OBJECT)).otherwise(each(found)))

    def fields(found: Column) -> Column:
        parts = []
        for name, (inner, required) in shape.fields.items():
            lab, y = child(F.lit(name)), found[name]
            missing = F.array(F.concat(lab, F.lit(f": {MSG_REQUIRED}"))) if required else F.lit(None).cast("array<string>")
            there = y.isNotNull() & (F.schema_of_variant(y) != "VOID") if name in NULLABLE else y.isNotNull()
            parts.append(_present(F.when(there, walk(y, inner, lab)).otherwise(missing)))
        return F.when(found.isNull(), fail(MSG_MODEL.format(shape.name))).otherwise(F.concat(*parts))

    return _opened(x, "map<string,variant>", fields)


def _opened(x: Column, kind: str, use) -> Column:
    """``use`` of the values in the VARIANT ``x`` (null if it is of another kind), which are taken out once."""
    return F.transform(F.array(F.try_variant_get(x, "$", kind)), use)[0]


def _present(messages: Column) -> Column:
    return F.coalesce(messages, F.array().cast("array<string>"))


def parse_manifests(df, text_col: str):
    """C8 over a table of manifest texts: parse once into a VARIANT, then walk it (:func:`walk`).

    A text that is no JSON, or null, has none of the sections.
    """
    parsed = F.coalesce(F.try_parse_json(F.col(text_col)), F.parse_json(F.lit("{}")))
    joined = F.transform(F.array(walk(F.col("__v"), MANIFEST)), _joined)[0]  # the walk is made once, its messages are read twice
    return df.withColumn("__v", parsed).withColumn("errors", joined).drop("__v")


def _indexed(prefix: str, i: Column, field: str, msg: str) -> Column:
    return F.concat(F.lit(prefix), i.cast("string"), F.lit(f".{field}: {msg}"))


def _enum_error(value: Column, prefix: str, i: Column, field: str, allowed: list[str], msg: str) -> Column:
    return F.when(value.isNull(), _indexed(prefix, i, field, MSG_REQUIRED)).when(
        ~value.isin(*allowed), _indexed(prefix, i, field, msg)
    )


def _rule_errors(rules: Column) -> Column:
    pre = "log_analysis.known_failure_patterns."
    per_rule = F.transform(
        rules,
        lambda r, i: F.array(
            F.when(r["pattern"].isNull(), _indexed(pre, i, "pattern", MSG_REQUIRED)),
            F.when(r["diagnosis"].isNull(), _indexed(pre, i, "diagnosis", MSG_REQUIRED)),
            _enum_error(r["action"], pre, i, "action", ["config_fix", "code_change", "escalate"], MSG_ACTION),
            F.when(r["auto_fix"].isNull(), _indexed(pre, i, "auto_fix", MSG_REQUIRED)),
        ),
    )
    return F.flatten(per_rule)


def _check_errors(checks: Column) -> Column:
    pre = "validation.checks."
    per_check = F.transform(
        checks,
        lambda c, i: F.array(
            F.when(c["name"].isNull(), _indexed(pre, i, "name", MSG_REQUIRED)),
            _enum_error(c["type"], pre, i, "type", ["exact", "tolerance"], MSG_CHECK_TYPE),
            _enum_error(c["severity"], pre, i, "severity", ["critical", "warning", "info"], MSG_SEVERITY),
        ),
    )
    return F.flatten(per_check)
