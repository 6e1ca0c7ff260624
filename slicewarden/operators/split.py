"""Good / bad / undecided splits and per-row failure tags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewarden.functions.rules import Rule, any_violation


@dataclass
class Split:
    """Three disjoint outputs of one slice.  ``undecided`` holds the rows whose
    bad predicate is NULL; the export keeps them out of both good and bad."""

    good: DataFrame
    bad: DataFrame
    undecided: DataFrame
    counts: DataFrame


def split_rows(df: DataFrame, rules: list[Rule], filter_bad: bool = True) -> Split:
    """Split on the OR of the rules' three-valued violations.

    With ``filter_bad=False`` every row is good (the pass-through switch).
    The three outputs are filters of one plan; Spark prunes each to the
    columns a consumer reads, and ``counts`` is one aggregation.
    """
    if not filter_bad:
        empty = df.where(F.lit(False))
        counts = df.agg(F.count(F.lit(1)).alias("rows_total")).select(
            "rows_total", F.col("rows_total").alias("rows_good"),
            F.lit(0).cast("long").alias("rows_bad"), F.lit(0).cast("long").alias("rows_undecided"))
        return Split(df, empty, empty, counts)
    bad = any_violation(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(~bad).alias("rows_good"),
        F.count_if(bad).alias("rows_bad"),
        F.count_if(bad.isNull()).alias("rows_undecided"),
    )
    return Split(df.where(~bad), df.where(bad), df.where(bad.isNull()), counts)


def failure_tags(tagged: list[tuple[str, Column]]) -> Column:
    """Comma list of the keys whose (never NULL) failure mask is true, in
    declaration order; '' when none."""
    return F.concat_ws(",", *[F.when(mask, F.lit(key)) for key, mask in tagged])
