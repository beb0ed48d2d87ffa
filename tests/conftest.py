import pytest

from quoteflow import session


@pytest.fixture(scope="session")
def spark():
    made = session.local(4, "quoteflow-tests")
    yield made
    session.clean(made)
    made.stop()
