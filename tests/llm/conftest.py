from __future__ import annotations

import pytest

from tagloom.llm.shared import Scratch


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


def rows_of(frame, *order):
    return sorted((tuple(r) for r in frame.collect()), key=repr) if not order else [tuple(r) for r in frame.orderBy(*order).collect()]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
