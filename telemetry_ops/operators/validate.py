"""Request validation, defaults, feature selection and row samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from telemetry_ops.config import NOT_FEATURES, REQUEST_APPLICATION, REQUEST_SCHEMA, REQUEST_SYSTEM
from telemetry_ops.functions import lcg


def parse_requests(df: DataFrame, column: str = "request") -> DataFrame:
    """Nested request texts to flat columns; text that is not JSON gives NULL fields and so is rejected later.

    Numbers may be given as text. What is no number (NaN included) becomes NULL, and its name goes to ``wrong_types``.

    The parsed value, and then the fields read from it, go through generators, which keep Catalyst from copying the parse, or
    the list of wrong types, into every later check.
    """
    as_text = T.StructType([T.StructField(part.name, T.StructType(
        [T.StructField(f.name, T.StringType()) for f in part.dataType])) for part in REQUEST_SCHEMA])
    parsed = df.select("*", F.inline(F.array(F.from_json(column, as_text))))
    fields = [(part.name, f) for part in REQUEST_SCHEMA for f in part.dataType]

    def read(part, field):
        if isinstance(field.dataType, T.StringType):
            return F.col(part)[field.name]
        return F.nanvl(F.col(part)[field.name].try_cast(field.dataType), F.lit(None).cast(field.dataType))

    wrong = [F.when(F.col(part)[f.name].isNotNull() & read(part, f).isNull(), F.lit(f.name)) for part, f in fields]
    return parsed.select(*df.columns, F.inline(F.array(F.struct(
        *[read(part, f).alias(f.name) for part, f in fields], F.array_compact(F.array(*wrong)).alias("wrong_types")))))


def violations(rules: dict, wrong_types: str | None = None) -> Column:
    """Array of reasons why a row breaks the rules; empty when it is valid.

    ``wrong_types`` names a column that lists the fields whose value could not be read.
    """
    reasons = []
    for name, rule in rules.items():
        value = F.col(name)
        wrong = F.array_contains(wrong_types, name) if wrong_types else F.lit(False)
        if wrong_types:
            reasons.append(F.when(wrong, F.lit(f"{name}: wrong type")))
        if rule.required:
            reasons.append(F.when(value.isNull() & ~wrong, F.lit(f"{name}: missing")))
        if rule.low is not None:
            reasons.append(F.when(value < rule.low, F.lit(f"{name}: below {rule.low:g}")))
        if rule.high is not None:
            reasons.append(F.when(value > rule.high, F.lit(f"{name}: above {rule.high:g}")))
    return F.array_compact(F.array(*reasons))


def with_violations(df: DataFrame, rules: dict | None = None) -> DataFrame:
    return df.withColumn("violations", violations(rules or {**REQUEST_SYSTEM, **REQUEST_APPLICATION},
                                                  "wrong_types" if "wrong_types" in df.columns else None))


def validate_rows(df: DataFrame, rules: dict | None = None):
    """Split into (valid, rejects); rejects keep their reasons."""
    checked = with_violations(df, rules)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def apply_defaults(df: DataFrame, defaults: dict, zero_is_missing: bool = False) -> DataFrame:
    """Fill missing optional readings. With ``zero_is_missing`` a reading of 0 is replaced as well."""
    def filled(name):
        if name not in defaults or defaults[name] is None:
            return F.col(name)
        value = F.nullif(F.col(name), F.lit(0)) if zero_is_missing else F.col(name)
        return F.coalesce(value, F.lit(defaults[name])).alias(name)
    return df.select(*[filled(c) for c in df.columns])


def request_defaults() -> dict:
    return {n: r.default for n, r in {**REQUEST_SYSTEM, **REQUEST_APPLICATION}.items() if r.default is not None}


def select_features(df: DataFrame, exclude=NOT_FEATURES) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(exclude)])


def conform(df: DataFrame, feature_names, keep=()) -> DataFrame:
    """Exactly the model's columns in the model's order: absent ones are 0, missing values are 0."""
    return df.select(*keep, *[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
        for c in feature_names])


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def sample_by_label(df: DataFrame, label: str, n: int, rid: str, seed: int = 42) -> DataFrame:
    """``n`` rows of each label, drawn by a key computed from the row id, so the draw repeats.

    The rank limit is pushed below the shuffle: every task passes on at most ``n`` rows per label.
    """
    w = Window.partitionBy(label).orderBy("_draw", rid)
    return (df.withColumn("_draw", lcg(rid, seed)).withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") <= n).drop("_draw", "_rank"))


def sample_rows(df: DataFrame, n: int, rid: str, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by a key computed from the row id."""
    return df.withColumn("_draw", lcg(rid, seed)).orderBy("_draw", rid).limit(n).drop("_draw")


def append(*parts: DataFrame) -> DataFrame:
    """Union by column name; absent columns become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def request_time(text, now) -> Column:
    """Time a request names, as ISO text with or without a zone (``Z`` or an offset); ``now`` where it names none or no valid
    one. Texts without a zone are in the session's."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.try_to_timestamp(F.trim(text)), now)
