"""Base columns of the licence scan against brute force over whole texts, and operators on empty tables."""

import re

import pytest

from haulmark.llm import licenses, pieces, queries, secrets
from tests.conftest import SF_DIR

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}  # fixed by the contract


def brute_licenses(value):
    """n_words, n_base, first_word, last_word and base_labels of one text, place by place."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in value or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_license_base_columns_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.op8_license_scan(spark, SF_DIR).collect()
    assert len(out) == len(texts) and any(r["n_base"] for r in out)
    for r in out:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_licenses(texts[r["doc_id"]])
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


@pytest.mark.parametrize("value", ["CC BY cc by", "cc by by cc\x00by", "All-Rights\treserved all rights reserved all rights", "éCC BY ccé by cc by",
                                   "GENERAL public  license " * 3000, "cc" + " " * 10_000 + "by"])
def test_license_base_columns_of_odd_texts(spark, value):
    row, = licenses.scan(spark.createDataFrame([(1, value)], "doc_id long, text string")).collect()
    assert tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_licenses(value)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.report(empty).count() == 0 and secrets.redact(empty).count() == 0
    assert pieces.encode(empty, queries.piece_model()).count() == 0
    assert licenses.scan(empty).count() == 0
