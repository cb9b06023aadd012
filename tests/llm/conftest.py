import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

#: Columns whose names the operators use themselves.
CLASHING = {"tag": "x", "n_words": 5, "runs": "r", "size": 1.5, "key": "k", "row": True, "score": "s", "range": 3,
            "copies": 9, "component_id": -1, "words": "w"}


@pytest.fixture()
def table(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(rows, partitions=3):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "src") for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})
    return make
