import pytest

from tidemark.llm import arrow


@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    monkeypatch.setattr(arrow, "SETTLE_SECONDS", 0)
