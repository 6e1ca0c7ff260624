"""Dataset-name rules for lineage planning, as Column expressions.

Names arrive as ``namespace:name``.  Object-store names (namespace ``gcs``)
are folder prefixes: a slash is put before ``date=`` when the name has no
slash at all, doubled slashes are collapsed once, and a trailing slash is
ensured.  Other names keep their text after the namespace.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace of object-store datasets and the hive date
# segment pattern (case-insensitive, at the start or after a slash).
FILE_NAMESPACE = "gcs"
DATE_SEGMENT = r"(?i)^((?:.*?/)?)date=\d{4}-\d{2}-\d{2}(/|$)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def namespace(name) -> Column:
    n = _c(name)
    return F.when(F.instr(n, ":") > 0, F.substring_index(n, ":", 1)).otherwise(F.lit(""))


def strip_namespace(name) -> Column:
    n = _c(name)
    return F.when(F.instr(n, ":") > 0, n.substr(F.instr(n, ":") + 1, F.lit(1 << 30))).otherwise(n)


def fix_file_path(name) -> Column:
    """Normalise an object-store prefix (no namespace)."""
    n = F.trim(F.coalesce(_c(name), F.lit("")))
    pos = F.instr(n, "date=")
    n = F.when(
        (F.instr(n, "/") == 0) & (pos > 1),
        F.concat(n.substr(F.lit(1), pos - 1), F.lit("/"), n.substr(pos, F.lit(1 << 30))),
    ).otherwise(n)
    n = F.replace(n, F.lit("//"), F.lit("/"))
    return F.when(n.endswith("/"), n).otherwise(F.concat(n, F.lit("/")))


def normalise(name) -> Column:
    """Canonical key: namespace dropped, object-store prefixes fixed."""
    n = _c(name)
    return F.when(namespace(n) == FILE_NAMESPACE, fix_file_path(strip_namespace(n))).otherwise(strip_namespace(n))


def retarget_date(path, run_date: str) -> Column:
    """Replace the first ``date=YYYY-MM-DD`` segment with the run date.

    The slashes around the segment are kept (the original swallowed them).
    """
    return F.regexp_replace(_c(path), DATE_SEGMENT, f"$1date={run_date}$2")


def is_file_dataset(name) -> Column:
    return namespace(name) == FILE_NAMESPACE
