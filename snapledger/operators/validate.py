"""Raw records and a SourceSpec to typed rows and quarantined ones, in one pass of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..sources.spec import Field, SourceSpec

REJECTED = ("source_recall_id", "raw_record", "failure_reason", "failure_stage", "raw_landing_path")


def _kind(f: Field) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{f.source}", "variant"))
    return F.when(kind != "VOID", kind)


def _field(f: Field, kind: Column, text: Column, present: Column) -> tuple[Column, Column]:
    value, bad = f.type(text, kind)
    error = F.when(kind.isNull(), F.when(F.lit(f.required), F.when(~present, f"{f.source}: missing").otherwise(f"{f.source}: null"))).when(F.coalesce(bad, F.lit(True)), f"{f.source}: not valid")
    if f.default == "array()":  # a missing list is an empty one, of the type that the parser gives
        value = F.when(kind.isNull(), f.type(parse.opened(f.type, F.lit("[]")), F.lit("ARRAY<VOID>"))[0]).otherwise(value)
    else:
        value = F.when(kind.isNotNull(), value)
    return value, error


def _held(rows: DataFrame) -> DataFrame:
    """The same rows, worked out once: Spark moves no filter below a generator that gives the columns of the filter."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _layout(raw: DataFrame) -> tuple[Column, Column]:
    drift = F.col("drift") if "drift" in raw.columns else F.lit(False)
    landed = F.col("raw_landing_path") if "raw_landing_path" in raw.columns else F.lit(None).cast("string")
    return landed.alias("raw_landing_path"), drift.alias("_drift")


def parsed(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """The spec's columns beside ``raw``, raw_landing_path, ``errors`` (sorted by field) and ``stage``.

    Keys that the spec doesn't know are errors, in nested elements too, as are wrong JSON types. What isn't
    a JSON object, or drifted from the file's layout, has no columns. Each step's columns are used several times by
    the next, so a record is parsed once, however many fields and later filters there are.
    """
    names = [f.source for f in spec.fields]
    rows = raw.select("raw", *_layout(raw)).withColumns({"_v": F.try_parse_json("raw"), "_m": F.from_json("raw", "map<string,string>")})
    rows = _held(rows)
    keys = F.coalesce(F.map_keys("_m"), F.array().cast("array<string>"))
    kinds = [_kind(f).alias(f"_k{i}") for i, f in enumerate(spec.fields)]
    texts = [parse.opened(f.type, F.try_element_at("_m", F.lit(f.source))).alias(f"_t{i}") for i, f in enumerate(spec.fields)]
    unknown = F.array_sort(F.array_except(keys, F.array(*map(F.lit, names))))
    rows = _held(rows.select("raw", "raw_landing_path", "_drift", F.col("_m").isNull().alias("_odd"), keys.alias("_keys"), unknown.alias("_unknown"), *kinds, *texts))
    fields = [_field(f, F.col(f"_k{i}"), F.col(f"_t{i}"), F.array_contains("_keys", f.source)) for i, f in enumerate(spec.fields)]
    unknown = F.transform("_unknown", lambda k: F.concat(k, F.lit(": unknown field")))
    rows = _held(rows.select("raw", "raw_landing_path", "_drift", "_odd", unknown.alias("_unknown"), F.array(*(error for _, error in fields)).alias("_errors"), *(value.alias(f.name) for f, (value, _) in zip(spec.fields, fields, strict=True))))
    every = F.when(F.col("_drift"), F.array(F.lit("wrong number of fields"))).when(F.col("_odd"), F.array(F.lit("not a JSON object"))).otherwise(F.concat("_unknown", F.array_compact("_errors")))
    return rows.select("raw", "raw_landing_path", F.when(F.col("_drift"), "extract").otherwise("validate_records").alias("stage"), every.alias("errors"), *spec.columns)


def split(rows: DataFrame, spec: SourceSpec) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of parsed() rows. Rejected ids are null where there is none."""
    valid = rows.where(F.size("errors") == 0).select(*spec.columns, "raw", "raw_landing_path")
    bad = rows.where(F.size("errors") > 0).select("source_recall_id", F.col("raw").alias("raw_record"), F.array_join("errors", "; ").alias("failure_reason"), F.col("stage").alias("failure_stage"), "raw_landing_path")
    return valid, bad


def _read(f: Field) -> tuple[Column, Column]:
    """Value and verdict of a field of a record whose keys and kinds are known to fit."""
    text = F.col(f"_r.{f.source}")
    if hasattr(f.type, "whole"):
        value, bad = f.type.whole(text)
    elif f.type.read != "string":
        value, bad = text, F.lit(False)
    else:
        value, bad = f.type(text, F.lit(f.type.kinds) if f.type.kinds.isalpha() else F.col(f"_k_{f.name}"))
    bad = F.coalesce(bad, F.lit(True))
    return value, (text.isNull() | bad) if f.required else (text.isNotNull() & bad)


def valid(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """The rows of parsed() without errors, found without working out the errors of the others.

    The schema of a record tells in one comparison whether keys and JSON types fit; what does is read as a whole.
    Records with errors get no further than that, unless it is a value that is wrong.
    """
    if not all(hasattr(f.type, "kinds") and f.source.isidentifier() and f.source.isascii() for f in spec.fields) or not any(f.required for f in spec.fields):
        return split(parsed(raw, spec), spec)[0]
    shape = parse.members({f.source: f.type.kinds for f in spec.fields}, {f.source for f in spec.fields if f.required})
    rows = _held(raw.select("raw", *_layout(raw), F.try_parse_json("raw").alias("_v")))
    rows = rows.where(~F.col("_drift") & F.schema_of_variant("_v").rlike(f"^OBJECT<{shape}>$"))
    several = [_kind(f).alias(f"_k_{f.name}") for f in spec.fields if f.type.read == "string" and not f.type.kinds.isalpha()]
    whole = F.from_json("raw", ", ".join(f"{f.source} {f.type.read}" for f in spec.fields)).alias("_r")
    rows = _held(rows.select("raw", "raw_landing_path", whole, *several))
    values, bad = zip(*map(_read, spec.fields), strict=True)
    wrong = bad[0]
    for x in bad[1:]:
        wrong = wrong | x
    rows = _held(rows.select("raw", "raw_landing_path", wrong.alias("_wrong"), *(v.alias(f.name) for f, v in zip(spec.fields, values, strict=True))))
    return rows.where("NOT _wrong").select(*spec.columns, "raw", "raw_landing_path")


def validate(raw: DataFrame, spec: SourceSpec) -> tuple[DataFrame, DataFrame]:
    return valid(raw, spec), split(parsed(raw, spec), spec)[1]


def rule_split(df: DataFrame, rules: dict[str, Column], id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, (id, reasons) of the others). A rule whose answer is null isn't kept."""
    errors = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in sorted(rules.items()))))
    marked = df.withColumn("_errors", errors)
    return marked.where(F.size("_errors") == 0).drop("_errors"), marked.where(F.size("_errors") > 0).select(id_col, F.array_join("_errors", ";").alias("reasons"))
