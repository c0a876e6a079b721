import pytest

from tallyhouse.session import build_session, clear_work


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    yield session
    clear_work(session)
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function on text values, in order."""

    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.select(expression("v").alias("out"), "i").orderBy("i").select("out").collect()]

    return run
