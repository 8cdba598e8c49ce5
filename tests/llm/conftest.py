from __future__ import annotations

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def documents(spark):
    """Documents from texts: ids in order, with a column that clashes with names used inside."""
    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "x", 0.5) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, score double")

    return make
