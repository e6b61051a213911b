import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path(os.environ.get("CALLSIEVE_TESTDATA", "/root/testdata"))
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A `documents` table from texts, or from (doc_id, text) or (doc_id, text, source, lang) tuples."""

    def made(rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, source, lang = ((i, row) if isinstance(row, str | None) else row) + (None, None)[
                : 4 - (2 if isinstance(row, str | None) else len(row))
            ]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOC_SCHEMA)

    return made
