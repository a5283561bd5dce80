"""Row functions on contact and identity fields, as JVM-side column expressions.

They follow Unicode string semantics (whitespace, digits, case folding), which
the engine's defaults do not: ``trim`` strips only U+0020 and ``\\D`` is ASCII.
Plain ASCII values, nearly all in practice, take a cheaper pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in a government id, the shape of an email address,
# the characters that count as whitespace, the digits a phone number may have, and
# (``SCORED_FIELDS``) the fields whose presence is counted.
_ID_NOISE = r"[^A-Z0-9]"
_EMAIL_SHAPE = r"\A[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\z"
_EMAIL_SHAPE_FOLDED = r"\A(?iu)[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\z"
_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_NON_DIGIT = r"[^0-9]"
_NON_DIGIT_UNICODE = r"(?U)\D"
PHONE_DIGITS = (8, 15)
SCORED_FIELDS = ("government_id", "first_name", "last_name", "birth_date", "email", "phone")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_government_id(c: Column | str) -> Column:
    """Upper-cased letters and digits only; NULL when nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(_col(c)), _ID_NOISE, ""), F.lit(""))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def normalize_email(c: Column | str) -> Column:
    """Lower-cased without surrounding whitespace of any kind; NULL when nothing is left."""
    return F.nullif(F.lower(F.btrim(_col(c), F.lit(_WHITESPACE))), F.lit(""))


def valid_email(c: Column | str) -> Column:
    """True when the normalized value is one whole address; NULL is not valid."""
    value = normalize_email(c)
    folded = ~_is_ascii(_col(c)) & value.rlike(_EMAIL_SHAPE_FOLDED)
    return F.coalesce(value.rlike(_EMAIL_SHAPE) | folded, F.lit(False))


def evidence_email(c: Column | str) -> Column:
    """The normalized address where it is valid, else NULL."""
    return F.when(valid_email(c), normalize_email(c))


def valid_phone(c: Column | str) -> Column:
    """True for 8 to 15 digits that are not all the same; NULL is not valid."""
    value = _col(c)
    digits = F.when(_is_ascii(value), F.regexp_replace(value, _NON_DIGIT, "")).otherwise(
        F.regexp_replace(value, _NON_DIGIT_UNICODE, "")
    )
    not_all_same = F.length(F.replace(digits, F.substring(digits, 1, 1), F.lit(""))) > 0
    return F.coalesce(F.length(digits).between(*PHONE_DIGITS) & not_all_same, F.lit(False))


def present(c: Column | str, is_text: bool = True) -> Column:
    """Neither NULL nor the empty string (whitespace counts as present)."""
    c = _col(c)
    return c.isNotNull() & (c != "") if is_text else c.isNotNull()


def completeness_score() -> Column:
    """How many of the six scored customer fields are present, 0 to 6."""
    tests = [f"{f} IS NOT NULL" if f == "birth_date" else f"{f} <> ''" for f in SCORED_FIELDS]
    return F.expr(" + ".join(f"IF({t}, 1, 0)" for t in tests))
