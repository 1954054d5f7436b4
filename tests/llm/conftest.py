import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Columns that operators use as names of their own.
CLASHES = ("version", "words", "counts", "fp", "ids", "tokens", "removed", "shard", "hits", "place", "line", "doc", "root", "key", "stratum")


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) rows, with columns whose names clash."""

    def build(rows, partitions=3):
        extra = ", ".join(f"{c} string" for c in CLASHES)
        full = [(*row, *["x"] * len(CLASHES)) for row in rows]
        return spark.createDataFrame(full, f"doc_id bigint, text string, {extra}").repartition(partitions)

    return build


@pytest.fixture
def edges():
    """Null, empty, blank, one-word, repeated and very long texts, a null id, and one id with two texts."""
    long = " ".join(f"long{i % 977} and text{i % 31}" for i in range(30000))
    return [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "word"), (5, "the same line of text is here twice\nThe same LINE of text is here twice"),
        (6, "a repeated row of the very same text"), (6, "a repeated row of the very same text"), (7, long), (8, long + " tail"),
        (None, "a document without any id at all"), (9, "one id with two texts"), (9, "and this is the other of both"),
        (10, "Ünïcode ßtraße 日本語 😀 mixed ＡＢＣ İstanbul K ſ"),
    ]
