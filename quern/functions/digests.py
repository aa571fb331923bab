"""Digests of sets of rows that add up: order-free sums of SHA-256, modulo 2^256.

A digest is eight numbers of 32 bits; tasks add those of their rows, Spark adds the sums, and carries
are moved up at the end. Equal rows count as often as they stand. Sums hold up to two thousand million
rows; beyond, Spark raises an overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LANES = 8


def row_digest(*cells: Column) -> Column:
    """SHA-256 over cells as text, nulls told from empty ones."""
    return F.sha2(F.concat_ws("\n", *[F.coalesce(F.concat(F.lit("+"), F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))), F.lit("-")) for c in cells]), 256)


def lanes(digest: Column, name: str = "lane") -> list[Column]:
    """The digest's eight numbers, the largest first."""
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"{name}{k}") for k in range(LANES)]


def summed(name: str = "lane") -> list[Column]:
    return [F.sum(f"{name}{k}").alias(f"{name}{k}") for k in range(LANES)]


def total(name: str = "lane") -> Column:
    """The sums of lanes with carries moved up, as 64 hexadecimal digits."""
    parts, carry = [], F.lit(0).cast("long")
    for k in reversed(range(LANES)):
        here = F.coalesce(F.col(f"{name}{k}"), F.lit(0).cast("long")) + carry
        parts.append(F.lpad(F.lower(F.hex(here.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), 8, "0"))
        carry = F.shiftright(here, 32)
    return F.concat(*reversed(parts))
