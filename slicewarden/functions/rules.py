"""Declared rules and the three ways a rule is compiled to a Spark Column.

One rule object serves three readings of NULL, which the pipeline uses in
different places:

* ``violation(..)``: SQL three-valued logic.  A NULL input gives a NULL
  violation, so a row can be neither good nor bad (the export split).
* expectation counting (``validate.run_suite``): NULLs are skipped; ``mostly``
  is the share of non-null values that must pass.
* ``strict_failure(..)``: NULL fails range and set tests (the CSV tagging).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
LENGTH_BETWEEN = "expect_column_value_lengths_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
EXPRESSION = "expect_expression_to_hold"


@dataclass(frozen=True)
class Rule:
    """One expectation: kind, column and arguments."""

    kind: str
    column: str | None = None
    min_value: Any = None
    max_value: Any = None
    values: tuple = field(default_factory=tuple)
    mostly: float = 1.0
    # For EXPRESSION rules: a SQL boolean that must hold, and its label.
    expr: str | None = None
    key: str | None = None

    # ---- construction helpers -------------------------------------------------
    @staticmethod
    def not_null(col: str, mostly: float = 1.0) -> "Rule":
        return Rule(NOT_NULL, col, mostly=mostly)

    @staticmethod
    def unique(col: str, mostly: float = 1.0) -> "Rule":
        return Rule(UNIQUE, col, mostly=mostly)

    @staticmethod
    def between(col: str, min_value=None, max_value=None, mostly: float = 1.0) -> "Rule":
        return Rule(BETWEEN, col, min_value, max_value, mostly=mostly)

    @staticmethod
    def in_set(col: str, values, mostly: float = 1.0) -> "Rule":
        return Rule(IN_SET, col, values=tuple(values), mostly=mostly)

    @staticmethod
    def length_between(col: str, min_value=None, max_value=None, mostly: float = 1.0) -> "Rule":
        return Rule(LENGTH_BETWEEN, col, min_value, max_value, mostly=mostly)

    @staticmethod
    def row_count(min_value=None, max_value=None) -> "Rule":
        return Rule(ROW_COUNT, None, min_value, max_value)

    @staticmethod
    def exists(col: str) -> "Rule":
        return Rule(EXISTS, col)

    @staticmethod
    def expression(key: str, expr: str) -> "Rule":
        return Rule(EXPRESSION, None, expr=expr, key=key)

    # ---- labels ------------------------------------------------------------------
    @property
    def label(self) -> str:
        if self.key:
            return self.key
        return f"{self.kind}:{self.column}" if self.column else self.kind

    @property
    def is_row_level(self) -> bool:
        return self.kind in (NOT_NULL, BETWEEN, IN_SET, LENGTH_BETWEEN, EXPRESSION)

    # ---- compile -----------------------------------------------------------------
    def _subject(self) -> Column:
        c = F.col(self.column)
        return F.length(c) if self.kind == LENGTH_BETWEEN else c

    def holds(self) -> Column:
        """Condition a passing row meets (three-valued; NULL input → NULL)."""
        if self.kind == NOT_NULL:
            return F.col(self.column).isNotNull()
        if self.kind in (BETWEEN, LENGTH_BETWEEN):
            return ~self.violation()
        if self.kind == IN_SET:
            return F.col(self.column).isin(list(self.values))
        if self.kind == EXPRESSION:
            return F.expr(self.expr)
        raise ValueError(f"{self.kind} is not a row-level rule")

    def violation(self) -> Column:
        """SQL three-valued violation, written the way the export predicate is:
        ``c < min OR c > max``, ``c NOT IN (..)``, ``c IS NULL``."""
        if self.kind == NOT_NULL:
            return F.col(self.column).isNull()
        if self.kind in (BETWEEN, LENGTH_BETWEEN):
            s = self._subject()
            parts = []
            if self.min_value is not None:
                parts.append(s < F.lit(self.min_value))
            if self.max_value is not None:
                parts.append(s > F.lit(self.max_value))
            if not parts:
                return F.lit(False)
            return reduce(lambda a, b: a | b, parts)
        if self.kind == IN_SET:
            return ~F.col(self.column).isin(list(self.values))
        if self.kind == EXPRESSION:
            return ~F.expr(self.expr)
        raise ValueError(f"{self.kind} is not a row-level rule")

    def strict_failure(self) -> Column:
        """Violation where NULL fails range and set tests (never NULL itself)."""
        if self.kind == NOT_NULL:
            return F.col(self.column).isNull()
        return ~F.coalesce(self.holds(), F.lit(False))

    def counted_violation(self) -> Column:
        """Violation among non-null values (expectation counting)."""
        if self.kind == NOT_NULL:
            return F.col(self.column).isNull()
        if self.kind == EXPRESSION:
            return F.coalesce(~F.expr(self.expr), F.lit(False))
        return F.col(self.column).isNotNull() & F.coalesce(self.violation(), F.lit(False))


def any_violation(rules: list[Rule]) -> Column:
    """OR-fold of three-valued violations: the export's bad predicate."""
    return reduce(lambda a, b: a | b, [r.violation() for r in rules])
