"""Contact and identity functions on edge strings; expectations are plain values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import (
    completeness_score,
    normalize_email,
    normalize_government_id,
    valid_email,
    valid_phone,
)

IDS = {
    " ar 100-2 ": "AR1002",
    "AR-1": "AR1",
    "": None,
    " - ": None,
    None: None,
    "straße9": "STRASSE9",
    "ñ12": "12",
    "a\tb\nc": "ABC",
    "٣4": "4",
}
EMAILS = {  # value: (normalized, valid)
    " ANA@Example.COM ": ("ana@example.com", True),
    "\tana@example.com\n": ("ana@example.com", True),
    " ana@example.com ": ("ana@example.com", True),
    "\x1cana@example.com\x1f": ("ana@example.com", True),
    "not-an-email": ("not-an-email", False),
    "a@b": ("a@b", False),
    "a@b.c": ("a@b.c", False),
    "a@b.co\nx": ("a@b.co\nx", False),
    "a b@c.de": ("a b@c.de", False),
    "a@b.co.": ("a@b.co.", False),
    "first.last+tag%x@sub-domain.example.org": ("first.last+tag%x@sub-domain.example.org", True),
    "a@ſite.com": ("a@ſite.com", True),
    "ı@b.co": ("ı@b.co", True),
    "ünal@example.com": ("ünal@example.com", False),
    "\u2003ana@example.com\u3000": ("ana@example.com", True),
    "ana@example.com\x00": ("ana@example.com\x00", False),
    "": (None, False),
    "  ": (None, False),
    None: (None, False),
}
PHONES = {
    "+54 11 5550-1001": True,
    "000": False,
    "00000000": False,
    "12345678": True,
    "1234567": False,
    "123456789012345": True,
    "1234567890123456": False,
    "٠١٢٣٤٥٦٧": True,
    "call 555-0100 x12": True,
    "": False,
    "no digits": False,
    None: False,
}


def _apply(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def test_government_id(spark):
    assert _apply(spark, IDS, normalize_government_id("v")) == list(IDS.values())


def test_email(spark):
    assert _apply(spark, EMAILS, normalize_email("v")) == [n for n, _ in EMAILS.values()]
    assert _apply(spark, EMAILS, valid_email("v")) == [ok for _, ok in EMAILS.values()]


def test_phone(spark):
    assert _apply(spark, PHONES, valid_phone("v")) == list(PHONES.values())


def test_completeness_counts_present_fields(spark):
    rows = [
        ("A", "x", "y", "1990-01-01", "e", "p"),
        ("", "x", "y", None, None, " "),
        (None, "", "", None, "", ""),
    ]
    df = spark.createDataFrame(
        rows, "government_id string, first_name string, last_name string, birth_date string, email string, phone string"
    ).withColumn("birth_date", F.col("birth_date").cast("date"))
    assert [r[0] for r in df.select(completeness_score()).collect()] == [6, 3, 0]
