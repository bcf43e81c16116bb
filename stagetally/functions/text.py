"""Text clean-up rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space, built from the rule itself.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# --- fixed values -----------------------------------------------------------------
LIFECYCLE_SYNONYMS = {"sales qualified lead": "salesqualifiedlead"}
CURRENCY_MARKS = ["$", ",", "€", "kr"]
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_URL_HEAD = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def null_if_blank(c: Column) -> Column:
    """Trimmed text; blank becomes NULL (reference fields, plain strings)."""
    return F.nullif(strip(c), F.lit(""))


def null_if_empty(c: Column) -> Column:
    """Only the empty string becomes NULL; the value itself is kept as it is."""
    return F.nullif(c, F.lit(""))


def normalize_email(c: Column) -> Column:
    return F.lower(strip(c))


def normalize_enum(c: Column) -> Column:
    """Lower case, trimmed; blank stays blank (the API path)."""
    return F.lower(strip(c))


def normalize_enum_null(c: Column) -> Column:
    """Lower case, trimmed; blank becomes NULL (the export path)."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def normalize_url_domain(c: Column) -> Column:
    """Lower-case scheme and host, keep the case of path, query and fragment.

    Text with neither scheme nor host is taken as a bare domain and lowered
    whole.  Empty ``?``, ``#`` and ``;`` tails are dropped, line breaks and
    tabs inside are removed, and a host with an unpaired bracket is left alone.
    """
    url = strip(c)
    compact = F.regexp_replace(url, r"[\t\r\n]", "")
    head = F.regexp_extract(compact, _URL_HEAD, 0)
    host = F.regexp_extract(compact, _URL_HEAD, 2)
    rest = F.substr(compact, F.length(head) + 1)
    rest = F.regexp_replace(rest, r"^([^#]*)#$", "$1")
    rest = F.regexp_replace(rest, r"^([^?#]*)\?(?=#|$)", "$1")
    rest = F.regexp_replace(rest, r"^((?:[^?#]*/)?[^/;?#]*);(?=[?#]|$)", "$1")
    unpaired = F.contains(host, F.lit("[")) != F.contains(host, F.lit("]"))
    return (
        F.when(unpaired, url)
        .when(head.isin("", "//"), F.lower(url))
        .otherwise(F.concat(F.lower(head), rest))
    )


def normalize_url_full(c: Column) -> Column:
    """Lower-case everything; blank becomes NULL."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def normalize_lifecycle_stage(c: Column) -> Column:
    value = strip(F.lower(c))
    out = value
    for spelled, known in LIFECYCLE_SYNONYMS.items():
        out = F.when(value == spelled, F.lit(known)).otherwise(out)
    return out


def normalize_lead_status(c: Column) -> Column:
    return F.replace(strip(F.lower(c)), F.lit(" "), F.lit("_"))


def clean_id(c: Column, numeric: bool = False) -> Column:
    """Identifier as text: numbers lose their fraction, blank text becomes NULL."""
    if numeric:
        return c.cast("bigint").cast("string")
    return null_if_blank(c)


def parse_amount(c: Column) -> Column:
    """Money text to double; anything that is not a plain number becomes NULL."""
    text = c
    for mark in CURRENCY_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    text = strip(text)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def bool_from_text(c: Column) -> Column:
    """True for a real true or the word in any case, else false."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def owner_display_name(first: Column, last: Column) -> Column:
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def append_note(existing: Column, note: Column) -> Column:
    return F.concat(F.coalesce(existing, F.lit("")), F.lit(" | "), note)
