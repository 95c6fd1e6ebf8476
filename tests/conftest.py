from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def read(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted(
            (tuple(row) for row in chosen.collect()),
            key=lambda row: tuple((value is not None, str(type(value)), value) for value in row),
        )

    return read


def plan_text(df) -> str:
    """The physical plan as Spark prints it."""
    return df._jdf.queryExecution().executedPlan().toString()
