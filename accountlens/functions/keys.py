"""Identifier normalisation. Both sides of every match go through these functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The legal forms removed from the end of a company name.
LEGAL_FORMS = [
    "incorporated", "corporation", "company", "limited", "gmbh",
    "corp", "inc", "llc", "ltd", "plc", "co",
]
_LEGAL_FORM_AT_END = " (" + "|".join(LEGAL_FORMS) + r")\z"


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def folded(c: Column) -> Column:
    """Lower case without outer spaces."""
    return F.lower(F.trim(c))


def domain_key(url: Column) -> Column:
    """Host of a URL or bare domain: no scheme, no leading ``www.``, no path, port or final dot."""
    text = folded(url)
    for scheme in ("https://", "http://"):
        text = F.replace(text, F.lit(scheme), F.lit(""))
    host = F.regexp_extract(F.regexp_replace(text, r"\Awww\.", ""), "^[^/?#:]*", 0)
    return _filled(F.regexp_replace(host, r"\.\z", ""))


def linkedin_slug(url: Column) -> Column:
    """The path segment after ``/company/``, null when there is none."""
    return _filled(F.regexp_extract(folded(url), "/company/([^/?#]*)", 1))


def name_words(name: Column) -> Column:
    """Company name in lower case without punctuation and without one trailing legal form."""
    plain = F.trim(F.translate(folded(name), "-.,()'", " "))
    return F.trim(F.regexp_replace(plain, _LEGAL_FORM_AT_END, ""))


def company_name_key(name: Column) -> Column:
    return _filled(F.replace(name_words(name), F.lit(" "), F.lit("")))


def name_first_token(name: Column) -> Column:
    return _filled(F.split_part(name_words(name), F.lit(" "), F.lit(1)))


def token_is_specific(token: Column, min_length: int) -> Column:
    return F.length(F.coalesce(token, F.lit(""))) >= min_length


def ticker_exchange(ticker: Column) -> Column:
    return F.when(F.contains(ticker, F.lit(":")), F.upper(F.split_part(ticker, F.lit(":"), F.lit(1))))


def ticker_symbol(ticker: Column) -> Column:
    part = F.when(F.contains(ticker, F.lit(":")), F.split_part(ticker, F.lit(":"), F.lit(2)))
    return F.upper(F.coalesce(part, ticker))


def email_domain(email: Column) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(2))
