"""Row validation and schema checks.

Rules are column expressions; one pass tags every row with the list of rules
it breaks, and the accepted / rejected outputs are two filters of that pass.
Nothing is dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatchError(ValueError):
    """Input lacks columns (or types) the model signature requires."""


def required(cols: Sequence[str]) -> list[tuple[str, Column]]:
    """One rule per required field: the value must be present."""
    return [(f"{c} is required", F.col(c).isNotNull()) for c in cols]


def tag_errors(df: DataFrame, rules: Sequence[tuple[str, Column]], out: str = "errors") -> DataFrame:
    """Add ``errors``: the messages of every rule the row breaks (a null check counts as broken)."""
    msgs = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(msg)) for msg, cond in rules]
    # array_except with [null] drops the passed rules; unlike a lambda filter it stays in codegen
    return df.withColumn(out, F.array_except(F.array(*msgs), F.array(F.lit(None).cast("string"))))


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``errors``) from one tagging pass."""
    t = tag_errors(df, rules)
    return t.where(F.size("errors") == 0).drop("errors"), t.where(F.size("errors") > 0)


def error_counts(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per rule: rule, violations; plus n_rows and n_rejected, all in one aggregate."""
    ok_all = F.lit(True)
    for _, c in rules:
        ok_all = ok_all & F.coalesce(c, F.lit(False))
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~ok_all).alias("n_rejected"),
                 *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"r{i}") for i, (_, c) in enumerate(rules)])
    structs = [F.struct(F.lit(m).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (m, _) in enumerate(rules)]
    return row.select("n_rows", "n_rejected", F.explode(F.array(*structs)).alias("s")).select("n_rows", "n_rejected", "s.*")


def check_signature(df: DataFrame, signature: Sequence[tuple[str, T.DataType]], strict_types: bool = False) -> None:
    """Fail fast, naming the missing (or mistyped) columns, before a model is applied."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n, _ in signature if n not in have]
    if missing:
        raise SchemaMismatchError(f"input lacks required columns: {', '.join(missing)}")
    if strict_types:
        wrong = [f"{n} ({have[n].simpleString()} != {t.simpleString()})" for n, t in signature if have[n] != t]
        if wrong:
            raise SchemaMismatchError(f"columns with the wrong type: {', '.join(wrong)}")


def signature_report(df: DataFrame, signature: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """column_name, expected_type, actual_type, non_null, nulls, ok: the signature checked against the
    schema and, in one aggregate pass, against the data (a required input must be present, of the
    expected type and never null) (P7, S5)."""
    from ..operators.profile import column_info

    present = [n for n, _ in signature if n in df.columns]
    info = column_info(df, present) if present else None
    sig = df.sparkSession.createDataFrame([(n, t.simpleString()) for n, t in signature],
                                          "column_name string, expected_type string")
    if info is None:
        out = sig.select("*", F.lit(None).cast("string").alias("actual_type"), F.lit(None).cast("long").alias("non_null"),
                         F.lit(None).cast("long").alias("nulls"))
    else:
        out = sig.join(info.select("column_name", F.col("dtype").alias("actual_type"), "non_null", "nulls"),
                       "column_name", "left")
    ok = F.coalesce(F.col("actual_type") == F.col("expected_type"), F.lit(False)) & F.coalesce(
        F.col("nulls") == 0, F.lit(False))
    return out.withColumn("ok", ok)
