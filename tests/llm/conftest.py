from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for folder in (ROOT, os.path.join(ROOT, "tests"), os.path.dirname(os.path.abspath(__file__))):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def small_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def texts(spark, small_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()}
