import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import TEXTS, rows  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, block int, shard int, item_id long, score string"

@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank and long texts, ties, repeated rows, and names that clash."""
    made = rows(TEXTS)
    return spark.createDataFrame([*made, made[8], made[8], (None, "no id here", None, None, None, None, None, None, None, None)], SCHEMA).repartition(3)



@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
