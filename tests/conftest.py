import pytest

from dimkeep.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            # Some tests look at the plans of their queries, also where a thousand have run before.
            "spark.sql.ui.retainedExecutions": "10000",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, columns in the given order."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
