"""Small shared helpers for plan shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it holds at most ``max_rows`` rows.

    The frame is computed once (a reliable checkpoint), its size is checked
    with a bounded count (``limit(max_rows + 1)``), and it is broadcast only
    when it fits; otherwise it is returned for a shuffle join.
    """
    small = materialize(df)
    if small.limit(max_rows + 1).count() > max_rows:
        return small
    return F.broadcast(small)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name in which null equals null: ``left``'s columns, then ``right``'s others."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in on])


def nan_as_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN counts as missing: null instead of NaN in the float and double columns among ``columns``."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(kinds[c]))
                           for c in dict.fromkeys(columns) if kinds[c] in ("float", "double")})


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches read: a reliable checkpoint into the folder the
    cluster names in ``spark.checkpoint.dir`` (set only when unset, for local runs). The frame is
    computed once; a lost executor re-reads the checkpoint instead of recomputing the upstream."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def round6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null."""
    return F.try_divide(num, den)


def zero_div(num: Column, den: Column) -> Column:
    """num / den with 0 on a zero denominator (the zero_division=0 rule)."""
    return F.coalesce(F.try_divide(num, F.when(den != 0, den)), F.lit(0.0))


def literal_bucket(value: Column, cuts: list[float], inclusive: bool = False) -> Column:
    """Number of literal cut points below ``value`` (``<=`` with ``inclusive``), as a balanced CASE tree.

    O(log n) comparisons per row and plain codegen'd expressions (no lambda).
    """
    cuts = sorted(cuts)

    def below(c):
        return (F.lit(c) <= value) if inclusive else (F.lit(c) < value)

    def tree(lo: int, hi: int) -> Column:  # answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2  # is the mid-th cut (1-based) below the value?
        return F.when(below(cuts[mid - 1]), tree(mid, hi)).otherwise(tree(lo, mid - 1))

    return tree(0, len(cuts))
