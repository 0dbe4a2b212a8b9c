"""Quoting for Spark SQL expression text built from fixed values."""

from __future__ import annotations


def quote(value: str | None) -> str:
    """A Spark SQL string literal (NULL for None)."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A back-quoted column name."""
    return "`" + name.replace("`", "``") + "`"
