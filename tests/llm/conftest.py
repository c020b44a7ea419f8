from __future__ import annotations

import pytest

from cases import ODD
from pyspark.sql import functions as F

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows, over several partitions."""
    def build(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, ROWS).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ROWS)


@pytest.fixture(scope="session")
def clashing(make):
    """Extra columns with the names that the operators use for their own."""
    names = ["n_tokens", "ids", "key", "node", "component", "kept", "mark", "doc", "spans", "row", "gram", "context",
             "chunk", "words", "value", "owner", "_base", "_more", "_key", "_found", "_kept_id", "entity", "set_key"]
    rows = [(1, "a text with password=abcdef123 in it"), (2, "another text, call +1 (203) 555-9729 now"), (3, None)]
    return make(rows).withColumns({n: F.lit("x") for n in names})
