"""Privacy: pseudonyms, identifier scans, the row-aligned leak test, and the gate."""

from __future__ import annotations

import os
import secrets

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.keys import pseudonym, ratio
from quern.functions.patterns import OLDEST_TOLD, IN_NAMES, PSEUDONYM_FORM, IN_TEXT

MATCH_CHARS = 60


def load_or_create_salt(path: str, variable: str = "QUERN_SALT") -> str:
    """The salt from the environment, else from the file, else 32 new random bytes kept there (0600)."""
    if value := os.environ.get(variable):
        return value
    if os.path.exists(path):
        with open(path) as f:
            return f.read().strip()
    value = secrets.token_hex(32)
    with open(os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600), "w") as f:
        f.write(value)
    return value


def pseudonym_map(rows: DataFrame, identifier: str, salt: str) -> DataFrame:
    """(identifier, pseudonym) of every distinct identifier that isn't null."""
    return rows.select(identifier).filter(F.col(identifier).isNotNull()).distinct().withColumn("pseudonym", pseudonym(F.col(identifier), salt))


def pseudonymize(rows: DataFrame, mapping: DataFrame, identifier: str, out: str = "patient", unknown: str = "PAT-UNKNOWN") -> DataFrame:
    """Rows with the pseudonym first and without the identifier."""
    rest = [c for c in rows.columns if c != identifier]
    joined = rows.join(mapping.select(identifier, "pseudonym"), identifier, "left")
    return joined.select(F.coalesce("pseudonym", F.lit(unknown)).alias(out), *rest)


def scan_text(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, issue, match): the first match of each pattern in each text, 60 characters of it."""
    cells = rows.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("cell")).select(key, "cell.*")
    cells = cells.filter("value is not null")
    # each pattern runs once, and one that needs a certain text only where that stands
    needs = {"email": "@", "url": "http"}
    match = lambda k, p: F.when(F.contains("value", F.lit(needs.get(k, ""))), F.regexp_extract("value", p, 0)).otherwise("")
    found = F.array(*[F.struct(F.lit(f"possible-{k}").alias("issue"), match(k, p).alias("match")) for k, p in IN_TEXT.items()])
    cells = cells.select(key, "column", F.explode(found).alias("f")).filter("f.match <> ''")
    return cells.select(key, "column", "f.issue", F.left("f.match", F.lit(MATCH_CHARS)).alias("match"))


def scan_names(names: DataFrame, column: str = "column") -> DataFrame:
    """(column, issue) for every token that a column's name holds, other characters as ``_``."""
    tokens = F.explode(F.array(*map(F.lit, IN_NAMES))).alias("token")
    plain = F.regexp_replace(F.lower(column), "[^a-z]", "_")
    return names.select(column, plain.alias("plain"), tokens).filter("contains(plain, token)").select(column, F.concat(F.lit("name-implies:"), "token").alias("issue"))


def scan_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """(source, column, issue, n_values) for the columns of tables whose names imply identifiers, and how many
    values they hold: a name alone leaks nothing. One pass over each table, columns by columns."""
    found = None
    for source, rows in tables.items():
        counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_values")) for c in rows.columns]))
        named = counts.select(pairs.alias("p")).select(F.lit(source).alias("source"), "p.*")
        found = named if found is None else found.union(named)
    issues = scan_names(found.select("column").distinct())
    return found.join(issues, "column").select("source", "column", "issue", "n_values")


def column_like(rows: DataFrame, prefix: str | None = None, name: str | None = None) -> str | None:
    """The first column whose name starts with ``prefix``, or is ``name``, in any case and with white space
    joined; None if there is none."""
    plain = lambda c: " ".join(c.split()).lower()
    fits = [c for c in rows.columns if (prefix is not None and plain(c).startswith(plain(prefix))) or (name is not None and plain(c) == plain(name))]
    return fits[0] if fits else None


def over_age(rows: DataFrame, key: str, age: str, limit: float = OLDEST_TOLD) -> DataFrame:
    """Rows whose age, read as a number, is above the limit."""
    value = F.col(age).try_cast("double")
    return rows.select(key, value.alias("value")).filter(F.col("value") > limit).withColumn("issue", F.lit(f"age-over-{int(limit)}"))


def _cell(column: str) -> Column:
    """A cell as trimmed text; 49.0 and 49 are alike."""
    text = F.trim(F.col(column).cast("string"))
    return F.when(text.rlike(r"^\d+\.0+$"), F.substring_index(text, ".", 1)).otherwise(text)


def _aligned(column: str, identifier: str) -> Column:
    """Whether a cell gives its own row's identifier, numbers compared as numbers."""
    cell, real = _cell(column), F.trim(F.col(identifier).cast("string"))
    digits = cell.rlike(r"^\d+$") & real.rlike(r"^\d+$")
    bare = lambda t: F.regexp_replace(t, r"^0+(?=\d)", "")
    return F.when(digits, bare(cell) == bare(real)).otherwise((cell == real) & (cell != ""))


def leak_fractions(export: DataFrame, identifier: str, columns: list[str], threshold: float = 0.2) -> DataFrame:
    """(column, aligned_rows, fraction, leaks) from one aggregate over all columns.

    A column leaks if more than ``threshold`` of its rows give their own row's identifier; matches
    with other rows' are chance.
    """
    sums = export.agg(F.count("*").alias("n"), *[F.count_if(_aligned(c, identifier)).alias(c) for c in columns])
    long = sums.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("aligned_rows")) for c in columns])).alias("s")).select("n", "s.*")
    fraction = ratio(F.col("aligned_rows"), F.col("n"))
    return long.select("column", "aligned_rows", fraction.alias("fraction"), (fraction > threshold).alias("leaks"))


def malformed(export: DataFrame, column: str = "patient") -> DataFrame:
    """Rows whose pseudonym isn't of the fixed form."""
    return export.filter(~F.coalesce(F.col(column).rlike(PSEUDONYM_FORM), F.lit(False)))


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, n_findings, result): PASS where a check has no finding."""
    parts = [df.agg(F.count("*").alias("n_findings")).select(F.lit(name).alias("check"), "n_findings") for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("result", F.when(F.col("n_findings") == 0, "PASS").otherwise("FAIL"))
