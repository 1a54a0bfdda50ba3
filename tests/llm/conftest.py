import pytest


@pytest.fixture(autouse=True)
def few_chunks(monkeypatch):
    """Tests are small: fewer chunks and buckets, so that each meets more than one document."""
    from accessaudit.llm import common, repeats

    monkeypatch.setattr(common, "MIN_CHUNKS", 5)
    monkeypatch.setattr(repeats, "MIN_BUCKETS", 4)
