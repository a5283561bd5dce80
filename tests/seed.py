"""A small source with one instance of every rule, and the change-set that follows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import apply_change_set
from tidemark.spec import ADVANCES, CARDS, CUSTOMERS, HISTORY, TRANSACTIONS, TableSpec

# id, government id, first, last, birth date, email, phone, test?, created = updated
_PEOPLE = [
    # One id in two spellings, nobody protected: the fuller record survives although it is younger.
    (11, "PT 55-01", "Ines", "Prado", "1990-03-02", "ines@mail.example", "+351 912 000 011", False, "2024-06-01"),
    (12, "pt5501", "Ines", "Prado", None, "", "", False, "2024-05-20"),
    # One id, two protected members: quarantined, the third member with them.
    (13, "PT-77", "Rui", "Costa", "1982-12-12", "rui@mail.example", "+351 912 000 013", False, "2024-06-02"),
    (14, "pt.77", "Rui", "Costa", "1982-12-12", "RUI@mail.example ", "+351 912 000 014", False, "2024-06-03"),
    (15, "PT 77", "R.", "Costa", "1982-12-12", "costa@mail.example", "+351 912 000 015", False, "2024-06-03"),
    (16, None, "Robot", "Contest", None, "bot@mail.example", "1", True, "2024-06-01"),
    # Same home address and birth date, no proof.
    (17, None, "Eva", "Lima", "1999-09-09", "home@mail.example", "+351 912 000 017", False, "2024-06-04"),
    (18, "", "Ema", "Lima", "1999-09-09", " HOME@mail.example", "+351 912 000 018", False, "2024-06-04"),
    # The protected member survives and takes over the address it lacks, malformed as it is.
    (19, "PT 90", "Jo", "Silva", "1975-01-01", "jo(at)mail", "11111111", False, "2024-05-01"),
    (20, "PT-90", "Jo", "Silva", "1975-01-01", None, "+351 912 000 020", False, "2024-06-05"),
]
# id, customer, status, cents, created, updated
_ADVANCES = [
    (501, 11, "requested", 30000, "2024-06-10", "2024-06-10"),
    (502, 13, "funded", 45000, "2024-06-11", "2024-06-12"),
    (503, 14, "paid_off", 52000, "2024-06-11", "2024-09-01"),
    (504, 20, "funded", 61000, "2024-06-13", "2024-06-14"),
    (505, 17, "cancelled", 12000, "2024-06-15", "2024-06-15"),
]
_CARDS = [
    ("c-a", 12, "k-1", "0101", "active", "2024-06-20"),
    ("c-b", 13, "k-2", "0202", "active", "2024-06-21"),
    ("c-c", 16, "k-3", "0303", "active", "2024-06-22"),
    ("c-d", 19, "k-4", "0404", "blocked", "2024-06-23"),
    ("c-e", 18, "k-5", "0505", "active", "2024-06-24"),
]
TRANSACTION_COUNT = 700


def typed(spark: SparkSession, spec: TableSpec, rows: list[tuple]) -> DataFrame:
    """Rows with dates and instants given as text, in the declared schema."""
    text = {"date", "timestamp"}
    ddl = ", ".join(
        f"{f.name} {'string' if f.dataType.typeName() in text else f.dataType.simpleString()}" for f in spec.schema.fields
    )
    return spark.createDataFrame(rows, ddl).select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields])


def source(spark: SparkSession) -> dict[str, DataFrame]:
    advances = typed(spark, ADVANCES, _ADVANCES)
    at = F.timestamp_seconds(F.lit(1719792000) + F.col("id") * 120)  # every two minutes from 2024-07-01
    transactions = spark.range(1, TRANSACTION_COUNT + 1).select(
        (F.col("id") + 900000).alias("transaction_id"),
        (F.col("id") % len(_ADVANCES) + 501).alias("advance_id"),
        F.when(F.col("id") % 4 == 0, F.lit("repayment")).otherwise(F.lit("disbursement")).alias("transaction_type"),
        (F.col("id") * 25).alias("amount_cents"),
        at.alias("occurred_at"),
        at.alias("updated_at"),
    )
    history = typed(spark, HISTORY, [(i + 1, a[0], a[2], a[5]) for i, a in enumerate(_ADVANCES)])
    return {
        "customers": typed(spark, CUSTOMERS, [(*p, p[-1]) for p in _PEOPLE]),
        "advances": advances,
        "cards": typed(spark, CARDS, [(*c, c[-1]) for c in _CARDS]),
        "transactions": transactions,
        "advance_status_history": history,
    }


_OPS = {
    "customers": [
        ("U", *_PEOPLE[6][:6], "+351 912 999 017", False, _PEOPLE[6][8], "2024-10-01 08:00:00"),
        ("I", 21, "PT 91", "Ana", "Reis", "2001-02-03", "ana@mail.example", "+351 912 000 021", False,
         "2024-10-01 08:30:00", "2024-10-01 08:30:00"),
    ],
    "advances": [("I", 506, 21, "requested", 9000, "2024-10-01 09:00:00", "2024-10-01 09:00:00")],
    "cards": [
        ("D", "c-e", None, None, None, None, None, None),
        ("I", "c-f", 21, "k-6", "0606", "active", "2024-10-01 09:10:00", "2024-10-01 09:10:00"),
    ],
    "transactions": [
        ("D", 900001, None, None, None, None, None),
        ("I", 950001, 502, "repayment", 700, "2024-10-01 09:20:00", "2024-10-01 09:20:00"),
    ],
}


def feeds(spark: SparkSession) -> dict[str, DataFrame]:
    """One update, two deletes and four inserts as change feeds."""
    out = {}
    for spec in (CUSTOMERS, ADVANCES, CARDS, TRANSACTIONS):
        ops, key = _OPS[spec.source], spec.key[0]
        named = spark.createDataFrame([(o[0], o[1]) for o in ops], f"op string, {key} {spec.schema[key].dataType.simpleString()}")
        out[spec.source] = typed(spark, spec, [o[1:] for o in ops]).join(named, key)
    return out


def changed(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The source after the change feeds."""
    specs = {s.source: s for s in (CUSTOMERS, ADVANCES, CARDS, TRANSACTIONS)}
    after = {n: apply_change_set(tables[n], feed, list(specs[n].key), [specs[n].cursor]) for n, feed in feeds(spark).items()}
    return {**tables, **after}
