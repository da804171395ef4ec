import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tagloom-tests", master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    from tagloom.session import fresh_folder

    return fresh_folder(spark, "test")


@pytest.fixture()
def table(spark):
    from tagloom.small import small_table

    return lambda rows, ddl: small_table(spark, rows, ddl)


def rows(df, *order):
    """Rows as sorted tuples."""
    columns = order or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_text(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
