from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus_samples import DOCS, clashing, frame, messy_rows  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    """The messy documents with columns that clash with the operators' own."""
    return clashing(frame(spark, messy_rows()))


@pytest.fixture(scope="session")
def nothing(spark):
    """The same table without rows."""
    return clashing(spark.createDataFrame([], DOCS))
