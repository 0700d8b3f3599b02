import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tenura.functions import domain as D
from tenura.session import local_session
from tenura.sources.files import text_schema

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # a few hundred rows: compiling generated code would take longer than running without it
    session = local_session(4, 2, spark_sql_codegen_wholeStage="false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


BASE = {
    "gender": "Male", "SeniorCitizen": "0", "Partner": "No", "Dependents": "No", "tenure": "10",
    "PhoneService": "Yes", "MultipleLines": "No", "InternetService": "DSL",
    **{c: "No" for c in D.RAW_COLUMNS[9:15]},
    "Contract": "Month-to-month", "PaperlessBilling": "Yes", "PaymentMethod": "Electronic check",
    "MonthlyCharges": "40.00", "TotalCharges": "400.00", "Churn": "No",
}
NO_NET = {c: "No internet service" for c in D.RAW_COLUMNS[9:15]}
ALL_NET = {c: "Yes" for c in D.RAW_COLUMNS[9:15]}


def customers():
    """Six customers, one per situation the pipeline treats differently."""
    return [
        {"customerID": "c1", "PhoneService": "No", "MultipleLines": "No phone service", "Partner": "Yes"},
        {"customerID": "c2", "Contract": "One year", "PaymentMethod": "Mailed check", "tenure": "30",
         "OnlineSecurity": "Yes", "DeviceProtection": "Yes", "MonthlyCharges": "55.5", "TotalCharges": "1650"},
        {"customerID": "c3", "SeniorCitizen": "1", "InternetService": "Fiber optic", "tenure": "3",
         "MonthlyCharges": "90", "TotalCharges": "270.6", "Churn": "Yes"},
        {"customerID": "c4", "InternetService": "No", **NO_NET, "tenure": "0", "TotalCharges": " ",
         "Contract": "Two year", "PaymentMethod": "Bank transfer (automatic)", "MonthlyCharges": "20.25"},
        {"customerID": "c5", "InternetService": "Fiber optic", **ALL_NET, "MultipleLines": "Yes", "tenure": "72",
         "Contract": "Two year", "PaymentMethod": "Credit card (automatic)", "MonthlyCharges": "115",
         "TotalCharges": "8200", "Dependents": "Yes"},
        {"customerID": "c6", "InternetService": "Fiber optic", "StreamingTV": "Yes", "tenure": "8",
         "MonthlyCharges": "99.65", "TotalCharges": "820.5", "Churn": "Yes"},
    ]


def raw_frame(spark, rows):
    return spark.createDataFrame([tuple({**BASE, **r}[c] for c in D.RAW_COLUMNS) for r in rows],
                                 text_schema(D.RAW_COLUMNS))


@pytest.fixture
def raw_sample(spark):
    return raw_frame(spark, customers())
