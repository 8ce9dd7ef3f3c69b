"""Output layouts: which input column feeds which CRM column, and through which formatter."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.functions import email_normalize, iso_utc, list_text, phone_normalize, rounded, state_code


class Out(NamedTuple):
    alias: str
    source: str
    format: str = "copy"


# Words a CRM column name spells differently from plain capitals.
SPELLING = {
    "id": "ID", "with": "with", "and": "and", "suv": "SUV", "msd": "MSD", "msds": "MSDs", "dot": "DOT", "mc": "MC",
    "ia": "IA", "phmsa": "PHMSA", "zcta": "ZCTA", "dsp": "DSP",
}
NAME_LIMIT = 40  # of a custom column, before its suffix
SUFFIX = "__c"

FORMATS = {
    "copy": lambda c: c,
    "text": lambda c: c.cast("string"),
    "cut40": lambda c: F.left(c, F.lit(40)),
    "iso": iso_utc,
    "round2": lambda c: rounded(c, 2),
    "round3": lambda c: rounded(c, 3),
    "state": state_code,
    "phone": phone_normalize,
    "email": email_normalize,
    "list": list_text,
    "or_false": lambda c: F.coalesce(c, F.lit(False)),
    "or_zero": lambda c: F.coalesce(c, F.lit(0).cast("bigint")),
    "known": lambda c: c.isNotNull(),
}


def crm_name(column: str) -> str:
    """``team_suv_count`` becomes ``Team_SUV_Count__c``."""
    words = [SPELLING.get(w, w.capitalize()) for w in column.split("_")]
    return "_".join(words)[:NAME_LIMIT] + SUFFIX


def same(columns: str, format: str = "copy") -> list[Out]:
    """Columns that keep their name, spelled the CRM way."""
    return [Out(crm_name(c), c, format) for c in columns.split()]


def made(columns: str) -> list[Out]:
    """Columns that already carry their output name."""
    return [Out(c, c) for c in columns.split()]


def with_counts(columns: dict[str, bool]) -> list[Out]:
    """Computed columns under their own name; those marked as counts are zero where unknown."""
    return [Out(name, name, "or_zero" if is_count else "copy") for name, is_count in columns.items()]


def _formatted(out: Out) -> Column:
    return FORMATS[out.format](F.col(out.source)).alias(out.alias)


def format_own(df: DataFrame, layout: list[Out], keep: list[str]) -> DataFrame:
    """Format the output columns that come from ``df`` itself, and keep ``keep`` for later steps.

    Done right after the scan: once per row, in a stage of its own, instead of after the joins,
    where the sampling for a final sort would evaluate everything twice.
    """
    have = set(df.columns)
    own = [out for out in layout if out.source in have and out.alias not in keep]
    return df.select(*keep, *map(_formatted, own))


def select_layout(df: DataFrame, layout: list[Out]) -> DataFrame:
    """All output columns in order; those not formatted before are formatted now."""
    done = set(df.columns) - {out.source for out in layout}
    return df.select(*[F.col(out.alias) if out.alias in done else _formatted(out) for out in layout])
