from __future__ import annotations

import pytest

from checks.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def drop_staged(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
