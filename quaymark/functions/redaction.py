"""Attributes that must not reach a log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names whose values are never shown, whatever their case.
SENSITIVE = ["row", "before", "after", "values", "payload", "plaintext", "pii", "key_values", "password", "secret", "token", "credential", "dsn", "url"]
REDACTED = "[redacted]"


def redact(attributes: Column) -> Column:
    """A map with the values of sensitive names replaced."""
    return F.transform_values(attributes, lambda k, v: F.when(F.lower(k).isin(SENSITIVE), REDACTED).otherwise(v))


def redact_nested(value):
    """The same for nested dictionaries on the driver."""
    if isinstance(value, dict):
        return {k: REDACTED if k.lower() in SENSITIVE else redact_nested(v) for k, v in value.items()}
    return [redact_nested(v) for v in value] if isinstance(value, list) else value
