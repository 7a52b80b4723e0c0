"""Draws that DuckDB can repeat."""

from __future__ import annotations


def draw_sql(seed: int, *key: str) -> str:
    """SQL of the number that mixture.draw() gives for columns."""
    joined = " || ".join([f"'{seed}'", *(f"'|' || CAST({k} AS VARCHAR)" for k in key)])
    return f"(CAST('0x' || substr(md5({joined}), 1, 13) AS BIGINT) / 4503599627370496.0)"
