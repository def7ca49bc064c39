import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = "digest string, print long, label string, kind int, salt int, content string, words string, _piece int, n long"


@pytest.fixture(scope="session")
def documents(spark):
    """rows: (doc_id, text) or (doc_id, text, source); with the columns of ``documents`` and clashing ones."""

    def make(rows, partitions=3):
        filled = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src", None, "x", 1, "y", 2, 3, "z", "w", 4, 5) for r in rows
        ]
        return spark.createDataFrame(filled, f"{DOCS}, {CLASHING}").repartition(partitions)

    return make
