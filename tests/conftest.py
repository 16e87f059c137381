import pytest

from clickweir.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", settings={
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one_row(spark):
    """Evaluate columns over literal text values: rows(values, column) -> list."""
    from pyspark.sql import functions as F

    def evaluate(values, build, type_name="string"):
        frame = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_name}")
        return [r[0] for r in frame.orderBy("i").select(build(F.col("c"))).collect()]

    return evaluate


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
