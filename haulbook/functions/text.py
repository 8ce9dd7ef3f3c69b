"""Text rules: states, phone numbers, e-mail domains, account names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# State names in test order with their postal codes. The first name found anywhere in
# the text wins, so "West Virginia" is reported as VA because "Virginia" is tested before it.
STATES = [
    ("alabama", "AL"), ("alaska", "AK"), ("arizona", "AZ"), ("arkansas", "AR"), ("california", "CA"),
    ("colorado", "CO"), ("connecticut", "CT"), ("delaware", "DE"), ("district of columbia", "DC"),
    ("florida", "FL"), ("georgia", "GA"), ("hawaii", "HI"), ("idaho", "ID"), ("illinois", "IL"),
    ("indiana", "IN"), ("iowa", "IA"), ("kansas", "KS"), ("kentucky", "KY"), ("louisiana", "LA"),
    ("maine", "ME"), ("maryland", "MD"), ("massachusetts", "MA"), ("michigan", "MI"),
    ("minnesota", "MN"), ("mississippi", "MS"), ("missouri", "MO"), ("montana", "MT"),
    ("nebraska", "NE"), ("nevada", "NV"), ("new hampshire", "NH"), ("new jersey", "NJ"),
    ("new mexico", "NM"), ("new york", "NY"), ("north carolina", "NC"), ("north dakota", "ND"),
    ("ohio", "OH"), ("oklahoma", "OK"), ("oregon", "OR"), ("pennsylvania", "PA"),
    ("rhode island", "RI"), ("south carolina", "SC"), ("south dakota", "SD"), ("tennessee", "TN"),
    ("texas", "TX"), ("utah", "UT"), ("vermont", "VT"), ("virginia", "VA"), ("washington", "WA"),
    ("west virginia", "WV"), ("wisconsin", "WI"), ("wyoming", "WY"),
]

# The accepted phone shapes and the rewrites applied to them.
DIALLED_LINK = r"tel://.+(\+1)?(\d{10})"
US_NUMBER = r"(\+1[\s-]*)*(\(\d{3}\)|\d{3})([\s.-]*)(\d{3})([\s.-]*)(\d{4})"
US_PARTS = r"^(\+1[\s-]*)?(\d{3})[\s.-]*(\d{3})[\s.-]*(\d{4})$"
ELEVEN_DIGITS_FIRST = r"1\d{10}.*"
TEN_DIGITS_FIRST = r"\d{10}.*"

# Rewrites that turn an e-mail pattern into a readable domain list, in this order.
DOMAIN_REWRITES = [
    (r"^\^", ""),  # leading caret
    (r"^\(\.\*\)\(", ""),  # leading (.*)(
    (r"\)\$", ""),  # every )$
    (r"\\", ""),  # escaping backslashes
    (r"\|", ", "),  # alternatives become a list
    ("@", ""),
]

NAME_LIMIT = 255


def full_match(text: Column, pattern: str) -> Column:
    """Whole-string regular expression match (Spark's own ``rlike`` finds a substring)."""
    return text.rlike(rf"\A(?:{pattern})\z")


def state_code(text: Column) -> Column:
    """Postal code for free-text state input, or null.

    No state name has two letters, so testing the short codes first gives the same result as testing
    them last and spares the common case fifty substring searches. Names of several words may have
    anything between them; that needs a pattern, tried only where the first word occurs.
    """
    code = F.upper(F.trim(text))
    name = F.lower(F.trim(text))
    rule = F.when(code.isin([c for _, c in STATES]), code)
    for state, value in STATES:
        words = state.split()
        found = name.contains(words[0])
        if len(words) > 1:
            found = found & name.like("%" + "%".join(words) + "%")
        rule = rule.when(found, value)
    return rule


def phone_normalize(phone: Column) -> Column:
    """US phone text to ``+1XXXXXXXXXX`` where recognised; junk to null; anything else unchanged."""
    junk = phone.ilike("tel%") | phone.ilike("%del%") | phone.isin("--", "")
    return (
        F.when(phone.ilike("tel://%"), F.concat(F.lit("+1"), F.regexp_replace(phone, DIALLED_LINK, "$2")))
        .when(full_match(phone, US_NUMBER), F.regexp_replace(phone, US_PARTS, "+1$2$3$4"))
        .when(junk, F.lit(None).cast("string"))
        .when(full_match(phone, ELEVEN_DIGITS_FIRST), F.concat(F.lit("+"), F.left(phone, F.lit(11))))
        .when(full_match(phone, TEN_DIGITS_FIRST), F.concat(F.lit("+1"), F.left(phone, F.lit(10))))
        .otherwise(phone)
    )


def email_normalize(email: Column) -> Column:
    return F.lower(F.trim(email))


def domain_list(pattern: Column) -> Column:
    """``^(.*)(@a\\.com|@b\\.com)$`` to ``a.com, b.com``."""
    return F.trim(reduce(lambda text, rule: F.regexp_replace(text, *rule), DOMAIN_REWRITES, pattern))


def stands_alone(account_type: Column, parent: Column) -> Column:
    """A company, or an account without a live parent."""
    return F.coalesce(account_type == "company", F.lit(False)) | parent.isNull()


def account_title(name: Column, company: Column, account_type: Column, parent: Column) -> Column:
    """Display name: blank names fall back to the company, child accounts carry it as a prefix."""
    unnamed = name.isNull() | (name == " ")
    title = (
        F.when(unnamed, F.concat(F.lit("Unnamed: "), company))
        .when(stands_alone(account_type, parent), name)
        .otherwise(F.concat(company, F.lit(" | "), name))
    )
    return F.left(title, F.lit(NAME_LIMIT))


def account_record_type(account_type: Column, parent: Column) -> Column:
    return F.when(stands_alone(account_type, parent), "Company").otherwise("Team Account")
