import sys
import tempfile
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from match_lake.session import build_session

    home = tempfile.mkdtemp(prefix="lake-tests-")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            # the tables are tiny: compiling a plan takes longer than running it
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.memory": "4g",
            # plans name the folders they scan, however long the path is
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.warehouse.dir": f"{home}/warehouse",
            "spark.checkpoint.dir": f"{home}/scratch",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"create database {name}")
    yield name
    spark.sql(f"drop database {name} cascade")


@pytest.fixture(scope="session")
def duck():
    from workload.check import connect

    return connect(SF_DIR)


def rows(df, *columns):
    """Rows as a sorted list of plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
