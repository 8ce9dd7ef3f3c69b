"""Column -> Column helpers. All are built-in expressions, so they stay inside code generation."""

from .arrays import contains_value, list_text, matches_any
from .numbers import exact_percent, rounded
from .text import (
    account_record_type,
    account_title,
    domain_list,
    email_normalize,
    full_match,
    phone_normalize,
    state_code,
)
from .times import as_of_date, days_before, iso_utc

__all__ = [
    "account_record_type",
    "account_title",
    "as_of_date",
    "contains_value",
    "days_before",
    "domain_list",
    "email_normalize",
    "exact_percent",
    "full_match",
    "iso_utc",
    "list_text",
    "matches_any",
    "phone_normalize",
    "rounded",
    "state_code",
]
