"""Boilerplate lines against brute force."""

from __future__ import annotations

from collections import defaultdict

import pytest
from edge import SCHEMA, rows

from envlake.llm import line_dedup


def brute(table, ratio=line_dedup.MAX_RATIO, least=line_dedup.MIN_PAGES):
    """Texts left, per row of (doc_id, text, site)."""
    pages = defaultdict(set)
    for _, text, site in table:
        pages[site].add(text or "")
    dropped = {}
    for site, texts in pages.items():
        counts = defaultdict(int)
        for text in texts:
            for line in {one.strip(" ") for one in text.split("\n")}:
                counts[line] += 1
        dropped[site] = {line for line, n in counts.items() if line and n >= least and n > ratio * len(texts)}
    return [(doc, "\n".join(x for x in (text or "").split("\n") if x.strip(" ") not in dropped[site])) for doc, text, site in table]


def test_equals_brute_force_on_edge_rows(spark):
    table = [
        (*row[:1], f"Home\n{row[1]}\n Contact " if row[1] and row[0] and row[0] < 100 else row[1], *row[2:]) for row in rows(n=90)
    ]
    frame = spark.createDataFrame(table, SCHEMA)
    kept = line_dedup.drop_boilerplate(frame)
    assert kept.columns == frame.columns
    want = brute([(row[0], row[1], row[3]) for row in table])
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    assert not any("Home" in text for _, text in want) and any(r.queue == "d" for r in kept.collect()) is False
    assert line_dedup.drop_boilerplate(frame.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [1, 50])
def test_copies_of_a_page_are_no_sign_of_boilerplate(spark, copies):
    table = [(k, f"only here {k}\nmore of {k}", "s") for k in range(60)] + [(100 + k, "a page\nthat is copied", "s") for k in range(copies)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string, source string")
    assert line_dedup.boilerplate(frame).count() == 0


def test_ratio_is_per_site(spark):
    table = [(k, f"menu\ntext {k}", "small") for k in range(10)] + [(100 + k, f"menu\npage {k}" if k < 9 else f"page {k}", "large") for k in range(400)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string, source string")
    found = [tuple(r) for r in line_dedup.boilerplate(frame).collect()]
    assert found == [("small", "menu", 10, 1.0)]
