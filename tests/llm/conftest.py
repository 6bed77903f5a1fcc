from __future__ import annotations

import random

import pytest


@pytest.fixture
def rnd():
    return random.Random(7)


@pytest.fixture
def docs(spark):
    """A maker of document tables from texts or whole rows."""

    def make(rows):
        full = [(i, r, "en", f"s{i % 3}", 0) if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
