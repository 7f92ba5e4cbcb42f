from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.telco import customers
from tidemark.functions import as_level, binary_label, name, to_number
from tidemark.operators import cleaning
from tidemark.operators.features import engineer_features
from tidemark.roles import ENGINEERED, TELCO, ColumnRoles
from tidemark.session import local_frame

BLANKS = ["", " ", None]


@pytest.mark.parametrize("blank", BLANKS)
def test_new_customer_keeps_blank_amount_as_zero(spark, blank):
    row = cleaning.clean(customers(spark, {"tenure": 0, "TotalCharges": blank}), TELCO).first()
    assert row["TotalCharges"] == 0.0


@pytest.mark.parametrize("blank", BLANKS)
def test_blank_amount_of_old_customer_is_quarantined(spark, blank):
    raw = customers(spark, {"tenure": 12, "TotalCharges": blank})
    assert cleaning.clean(raw, TELCO).isEmpty()
    assert cleaning.quarantine(raw, TELCO).first()["reason"] == "missing amount"


def test_mixed_rows(spark):
    raw = customers(
        spark,
        {"customerID": "new", "tenure": 0, "TotalCharges": ""},
        {"customerID": "bad", "tenure": 5, "TotalCharges": ""},
        {"customerID": "odd", "tenure": 5, "TotalCharges": "12x"},
        {"customerID": "ok", "tenure": 24, "TotalCharges": "1200.50"},
        {"customerID": "unknown", "tenure": None, "TotalCharges": None},
        {"customerID": "zero", "tenure": 0, "TotalCharges": "7"},
    )
    kept = {r["customerID"]: r["TotalCharges"] for r in cleaning.clean(raw, TELCO).collect()}
    assert kept == {"new": 0.0, "ok": 1200.50, "zero": 7.0}
    reasons = {r["customerID"]: r["reason"] for r in cleaning.quarantine(raw, TELCO).collect()}
    assert reasons == {
        "bad": "missing amount",
        "odd": "unreadable amount",
        "unknown": "missing amount",
    }
    summary = {r["reason"]: r["n"] for r in cleaning.quarantine_summary(raw, TELCO).collect()}
    assert summary == {"missing amount": 2, "unreadable amount": 1}


def test_text_to_number(spark):
    cases = {
        "1": 1.0, " 2.5 ": 2.5, "1e3": 1000.0, "-.5": -0.5, "5.": 5.0, "+7": 7.0,
        "1d": None, "1f": None, "nan": None, "": None, " ": None, "abc": None, "1_000": None,
        "inf": float("inf"), None: None,
    }
    df = local_frame(spark, [(k,) for k in cases], "t string")
    got = df.select("t", to_number(F.col("t"), "string").alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == cases


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(to_number(F.col("v"), "double")).collect()] == [None, 1.0]


def test_levels_of_booleans_and_nulls(spark):
    df = spark.createDataFrame([(True, "a"), (False, None), (None, "b")], "f boolean, s string")
    rows = df.select(as_level(F.col("f"), "boolean"), as_level(F.col("s"), "string")).collect()
    assert [tuple(r) for r in rows] == [("True", "a"), ("False", "<NA>"), ("<NA>", "b")]


def test_labels(spark):
    df = spark.createDataFrame(
        [("Yes", 1, True), ("No", 0, False), ("maybe", 2, None), (None, None, None)],
        "s string, i int, b boolean",
    )
    types = dict(df.dtypes)
    rows = df.select(*[binary_label(F.col(c), types[c]).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1), (0, 0, 0), (None, None, None), (None, None, None)]


def test_unknown_labels_are_counted(spark):
    raw = customers(spark, {"Churn": True}, {"Churn": None})
    assert tuple(cleaning.unknown_labels(raw, TELCO).first()) == (1, 2)


def test_engineered_values(spark):
    raw = customers(
        spark,
        {
            "tenure": 24,
            "TotalCharges": "1200",
            "OnlineSecurity": "Yes",
            "TechSupport": "Yes",
            "Contract": "Month-to-month",
            "PaymentMethod": "Electronic check",
        },
    )
    row = engineer_features(cleaning.clean(raw, TELCO), TELCO).first()
    assert row["avg_monthly_charge"] == 50.0
    assert row["tenure_bucket"] == "13-24"
    assert row["addon_count"] == 2.0
    assert row["month_to_month_electronic"] == 1.0


@pytest.mark.parametrize(
    ("tenure", "bucket"),
    [(0, "0-12"), (12, "0-12"), (13, "13-24"), (24, "13-24"), (48, "25-48"), (49, "49+"), (None, "nan")],
)
def test_tenure_buckets(spark, tenure, bucket):
    df = local_frame(spark, [(tenure, 10.0, "x", "y")], "tenure double, total double, contract string, payment string")
    roles = ColumnRoles("id", "label", ("tenure", "total"), ("contract", "payment"))
    row = engineer_features(df, roles).first()
    assert row["tenure_bucket"] == bucket
    assert (row["avg_monthly_charge"] is None) == (tenure is None)


def test_feature_lists():
    assert len(TELCO.feature_columns()) == 18
    assert len(TELCO.feature_columns(ENGINEERED)) == 22
    assert "tenure" in TELCO.feature_columns()
    assert "customerID" not in TELCO.feature_columns()
    with pytest.raises(ValueError, match="feature_set"):
        TELCO.feature_columns("other")
    with pytest.raises(ValueError, match="Not allowed"):
        ColumnRoles("id", "label", ("id",), ())


def test_scoring_needs_no_label(spark):
    raw = customers(spark, {"customerID": "cust-1"}).drop("Churn")
    features = cleaning.scoring_features(raw, TELCO)
    assert features.columns == ["customerID", *TELCO.feature_columns()]
    assert features.first()["customerID"] == "cust-1"


def test_schema_check(spark):
    df = spark.createDataFrame([(1, 2)], "a int, c int")
    with pytest.raises(ValueError, match=r"Missing feature columns: \['b'\]"):
        cleaning.validate_schema(df, ["a", "b"])
    with pytest.raises(ValueError, match=r"Unexpected columns: \['c'\]"):
        cleaning.validate_schema(df, ["a"])
    assert cleaning.validate_schema(df, ["a"], exact=False) is df


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1,)], "`a.b` int")
    assert df.select(name("a.b")).first()[0] == 1
