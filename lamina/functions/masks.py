"""Column masking expressions; the strategy names match the governance tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRATEGIES = (
    "none",
    "nullify",
    "hash_sha256",
    "redact_email",
    "redact_ssn",
    "truncate_middle",
    "truncate_end",
)


def _stars(count: Column) -> Column:
    return F.repeat(F.lit("*"), count.cast("int"))


def _keep_ends(text: Column, hidden: Column) -> Column:
    return F.concat(F.left(text, F.lit(1)), _stars(hidden), F.right(text, F.lit(1)))


def redact_email(column: Column) -> Column:
    text = column.cast("string")
    local = F.split_part(text, F.lit("@"), F.lit(1))
    size = F.length(local)
    masked = F.when(size <= 2, _stars(size)).otherwise(_keep_ends(local, size - 2))
    with_domain = F.concat(masked, F.lit("@"), F.split_part(text, F.lit("@"), F.lit(2)))
    return F.when(F.contains(text, F.lit("@")), with_domain).otherwise(_stars(F.length(text)))


def redact_ssn(column: Column) -> Column:
    digits = F.regexp_replace(column.cast("string"), r"\D", "")
    return F.concat(F.lit("***-**-"), F.right(digits, F.lit(4)))


def truncate_middle(column: Column) -> Column:
    text = column.cast("string")
    size = F.length(text)
    return F.when(size <= 4, _stars(size)).otherwise(
        _keep_ends(text, F.greatest(size - 2, F.lit(2)))
    )


def truncate_end(column: Column, classification: str | None = None) -> Column:
    keep = 4 if classification == "confidential" else 8
    text = column.cast("string")
    size = F.length(text)
    return F.when(size <= keep, _stars(size)).otherwise(
        F.concat(F.left(text, F.lit(keep)), _stars(F.greatest(size - keep, F.lit(2))))
    )


def mask(column: Column, strategy: str, classification: str | None = None) -> Column:
    if strategy == "none":
        return column
    if strategy == "nullify":
        return F.lit(None).cast("string")
    if strategy == "hash_sha256":
        return F.sha2(column.cast("string"), 256)
    if strategy == "redact_email":
        return redact_email(column)
    if strategy == "redact_ssn":
        return redact_ssn(column)
    if strategy == "truncate_middle":
        return truncate_middle(column)
    if strategy == "truncate_end":
        return truncate_end(column, classification)
    raise ValueError(f"unknown masking strategy {strategy!r}")


def unmask_for(raw: Column, masked: Column, role: str | None, active_roles: set[str]) -> Column:
    """The raw value when the caller holds ``role``, else the mask (both as text)."""
    if role is None:
        return masked
    return F.when(F.lit(role in active_roles), raw.cast("string")).otherwise(masked)
