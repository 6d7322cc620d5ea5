"""Declared schemas. No schema inference in production paths."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

MONEY = DecimalType(18, 2)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# The operational bulk-load file: dates still text (day-first), money declared decimal.
ADMISSIONS_FILE = _s(
    ("name", StringType(), True), ("age", IntegerType(), True), ("gender", StringType(), True),
    ("blood_type", StringType(), True), ("medical_condition", StringType(), True),
    ("admission_date", StringType(), True), ("doctor", StringType(), True),
    ("insurance_provider", StringType(), True), ("billing_amount", MONEY, True),
    ("room_number", IntegerType(), True), ("admission_type", StringType(), True),
    ("discharge_date", StringType(), True), ("medication", StringType(), True),
    ("test_results", StringType(), True), ("hospital", StringType(), True),
)

# The main table after date parsing.
ADMISSIONS = StructType([
    StructField(f.name, DateType() if f.name in ("admission_date", "discharge_date") else f.dataType, True)
    for f in ADMISSIONS_FILE.fields
])

# Staging: every field text.
STAGING = _s(("name", StringType(), True), ("medical_condition", StringType(), True),
             ("billing_amount", StringType(), True), ("admission_date", StringType(), True),
             ("discharge_date", StringType(), True))

BILLING_TEST = _s(("patient_name", StringType(), True), ("billing_amount", MONEY, True),
                  ("admission_date", DateType(), True), ("discharge_date", DateType(), True))

CONSTRAINED = _s(("patient_name", StringType(), False), ("medical_condition", StringType(), True),
                 ("billing_amount", MONEY, True), ("admission_date", DateType(), True),
                 ("discharge_date", DateType(), True))

TRANSACTIONS = _s(("transaction_id", LongType(), False), ("account_number", StringType(), False),
                  ("transaction_date", DateType(), False), ("amount", MONEY, True),
                  ("transaction_type", StringType(), True), ("status", StringType(), True))

REFERRALS = _s(("referral_id", IntegerType(), False), ("patient_name", StringType(), True),
               ("from_department", StringType(), True), ("to_department", StringType(), True),
               ("parent_referral_id", IntegerType(), True))

SKEWED_ADMISSIONS = _s(("admission_id", LongType(), False), ("patient_name", StringType(), True),
                       ("medical_condition", StringType(), True), ("admission_type", StringType(), True),
                       ("billing_amount", MONEY, True), ("admission_date", DateType(), True))

# The central error log; error_id is a deterministic string, not an identity.
ERROR_LOG = _s(("error_id", StringType(), False), ("error_number", IntegerType(), True),
               ("error_severity", IntegerType(), True), ("error_state", IntegerType(), True),
               ("error_procedure", StringType(), True), ("error_line", IntegerType(), True),
               ("error_message", StringType(), True), ("error_datetime", TimestampType(), True),
               ("process_context", StringType(), True))
