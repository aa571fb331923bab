"""Hashes, tokens, identifiers and rounding as column expressions that SQL engines can repeat."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLOCK = 64


def _pads(key: str) -> tuple[str, str]:
    """The two padded keys of HMAC-SHA256, in hexadecimal."""
    import hashlib

    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > BLOCK else raw).ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


def hmac_sha256(message: Column, key: str) -> Column:
    """HMAC-SHA256 of a text column, in hexadecimal, from built-in functions."""
    inner, outer = _pads(key)
    digest = F.sha2(F.concat(F.unhex(F.lit(inner)), message.cast("binary")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(digest)), 256)


def pseudonym(identifier: Column, key: str, length: int = 12, prefix: str = "PAT-") -> Column:
    """A keyed token for an identifier; the same key gives the same token."""
    return F.concat(F.lit(prefix), F.substring(hmac_sha256(identifier.cast("string"), key), 1, length))


def stable_hash32(text: Column) -> Column:
    """The first four bytes of SHA-256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(text.cast("string"), 256), 1, 8), 16, 10).cast("long")


def draw(n: Column | int, *parts: Column | str | int) -> Column:
    """A deterministic draw from 0 to n - 1 out of the parts."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.pmod(stable_hash32(text), n if isinstance(n, Column) else F.lit(n))


def shuffle_key(seed: int, *parts: Column) -> Column:
    """A text that orders rows at random but alike on every run and in any input order."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)


def pad_id(identifier: Column, width: int = 3) -> Column:
    """Zero-padded to ``width``; longer identifiers stay whole."""
    text = identifier.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def replace_segment(path: Column, old: Column, new: Column) -> Column:
    """Replace the path segments that equal ``old``, and no part of others."""
    return F.array_join(F.transform(F.split(path, "/"), lambda s: F.when(s == old, new).otherwise(s)), "/")


def rounded(x: Column, places: int = 4) -> Column:
    """Half-up rounding by one formula that other engines repeat bit for bit."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom, or ``empty`` where bottom is 0."""
    return F.when(bottom == 0, F.lit(empty).cast("double")).otherwise(top.cast("double") / bottom)
