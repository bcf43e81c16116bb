"""Whole-row rules: normalising, validating and flattening a table's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions import text
from stagetally.schemas import LOWERCASE_FIELDS, URL_FIELDS


def _covered(field: str, table: str | None, rules: dict[str, list[str]]) -> bool:
    """A known table uses its own list; otherwise any table's list applies."""
    if table in rules:
        return field in rules[table]
    return any(field in fields for fields in rules.values())


def _rule(field: str, table: str | None) -> str | None:
    if _covered(field, table, URL_FIELDS):
        return "url"
    if field == "email" or field.endswith("_email"):
        return "email"
    if _covered(field, table, LOWERCASE_FIELDS):
        return "enum"
    return None


_RULES = {
    "url": text.normalize_url_domain,
    "email": text.normalize_email,
    "enum": text.normalize_enum,
}


def _text_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def normalize_fields(df: DataFrame, table: str | None = None) -> DataFrame:
    """Apply the URL, e-mail or enum rule to every text column it covers."""
    changed = {
        name: _RULES[rule](F.col(name))
        for name in _text_fields(df)
        if (rule := _rule(name, table)) is not None
    }
    return df.withColumns(changed)


def validate_normalized(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row per value that breaks a rule: keys, field, rule, value, expected.

    The rules are independent, so an address with capitals in the owners table
    is reported both as an enum field and as an e-mail field.
    """
    found = []
    for name in _text_fields(df):
        value = F.col(name)
        checks = []
        if name in LOWERCASE_FIELDS.get(table, []):
            checks.append(("enum", value != F.lower(value), F.lower(value)))
        if name in URL_FIELDS.get(table, []):
            clean = text.normalize_url_domain(value)
            checks.append(("url", value != clean, clean))
        if name == "email" or name.endswith("_email"):
            checks.append(
                ("email", value.contains("@") & (value != F.lower(value)), F.lower(value))
            )
        for rule, broken, expected in checks:
            found.append(
                F.when(
                    broken,
                    F.struct(
                        F.lit(name).alias("field"),
                        F.lit(rule).alias("rule"),
                        value.alias("value"),
                        expected.alias("expected"),
                    ),
                )
            )
    if not found:
        raise ValueError(f"table {table!r} has no field with a rule")
    return df.select(*keys, F.inline(F.array_compact(F.array(*found))))


def stringify_complex(df: DataFrame) -> DataFrame:
    """Columns as stored: nested values as JSON text, every ``*_id`` as text.

    ``snapshot_id`` keeps its type because fact tables are partitioned by it.
    """
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif f.name.endswith("_id") and f.name != "snapshot_id":
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)
