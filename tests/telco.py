"""Rows of the telecom customer table, by the default row of FIXTURES.md."""

from __future__ import annotations

import random

from tidemark.session import local_frame

SCHEMA = (
    "customerID string, gender string, SeniorCitizen int, Partner boolean, Dependents boolean,"
    " tenure int, PhoneService boolean, MultipleLines string, InternetService string,"
    " OnlineSecurity string, OnlineBackup string, DeviceProtection string, TechSupport string,"
    " StreamingTV string, StreamingMovies string, Contract string, PaperlessBilling boolean,"
    " PaymentMethod string, MonthlyCharges double, TotalCharges string, Churn boolean"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
DEFAULTS = dict(
    zip(
        NAMES,
        (
            "c-1", "Female", 0, True, False, 12, True, "No", "DSL", "No", "No", "No", "No", "No",
            "No", "Month-to-month", True, "Electronic check", 50.0, "600", False,
        ),
        strict=True,
    )
)


def customer(**values) -> tuple:
    return tuple({**DEFAULTS, **values}[n] for n in NAMES)


def customers(spark, *rows: dict):
    return local_frame(spark, [customer(**r) for r in rows], SCHEMA)


def population(spark, n: int = 160, seed: int = 0):
    """Random customers whose label follows tenure and charge."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tenure, monthly = rng.randint(1, 71), round(rng.uniform(20, 120), 2)
        rows.append(
            {
                "customerID": f"cust-{i}",
                "gender": rng.choice(["Female", "Male"]),
                "tenure": tenure,
                "MonthlyCharges": monthly,
                "TotalCharges": str(round(monthly * tenure, 2)),
                "Contract": rng.choice(["Month-to-month", "One year", "Two year"]),
                "Churn": tenure < 12 or monthly > 90,
            }
        )
    return customers(spark, *rows)
