"""Row hashes for change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_diff(*cols: str) -> Column:
    """Hex SHA-256 of the JSON text of a struct of the given attributes.

    ``ignoreNullFields=false`` keeps ``"region":null`` in the text, so a NULL
    attribute hashes differently from an absent one, as TO_JSON_STRING does.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return F.sha2(payload, 256)
