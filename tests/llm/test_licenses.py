"""Licence notices against brute force, and the plan."""

from __future__ import annotations

import re

import pytest
from edge import SCHEMA, rows

from envlake.llm import licenses


def bigrams(text):
    words = re.sub(r"[^a-z0-9.]+|\.(?![0-9])", " ", text.lower()).split()
    return set(zip(words, words[1:], strict=False))


def brute(table, least=licenses.MIN_DICE):
    found = set()
    for doc, text in table:
        text = text or ""
        units = [("line", k, u) for k, u in enumerate(text.split("\n"))]
        units += [("paragraph", k, u) for k, u in enumerate(re.split(r"\n[\x20\t\r]*\n", text)) if "\n" in u]
        for kind, number, unit in units:
            own = bigrams(unit)
            scored = [
                (-round(2 * len(own & bigrams(notice)) / (len(own) + len(bigrams(notice))), 9), name)
                for name, notice in licenses.TEMPLATES.items()
            ]
            if own and -min(scored)[0] >= least:
                found.add((doc, kind, number, min(scored)[1], -min(scored)[0]))
    return found


NOTICES = [
    (200, "Some text\nReleased under the MIT License.\nmore"),
    (201, "RELEASED under the mit-license!"),
    (202, licenses.TEMPLATES["MIT-permission"].replace(" copy", "\ncopy") + "\n\nother words here"),
    (203, "Licensed under the Apache License, Version 2.1."),
    (204, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
    (205, "This work is licensed under the GNU General Public License, version 4."),
    (206, "licensed under nothing at all"),
    (207, "License"),
]


def test_equals_brute_force(spark):
    table = rows() + [(doc, text, *[None] * 9) for doc, text in NOTICES] + [(200, NOTICES[0][1], *[None] * 9)]
    frame = spark.createDataFrame(table, SCHEMA)
    found = {tuple(r) for r in licenses.scan(frame).collect()}
    assert found == brute([row[:2] for row in table])
    assert {r[0] for r in found} >= {200, 201, 202, 204}
    assert licenses.scan(frame).count() == len(found)
    assert licenses.scan(frame.limit(0)).collect() == []


@pytest.mark.parametrize("least", [0.5, 0.95])
def test_other_limits(spark, least):
    frame = spark.createDataFrame(NOTICES, "doc_id bigint, text string")
    assert {tuple(r) for r in licenses.scan(frame, min_dice=least).collect()} == brute(NOTICES, least)


def test_plan_is_native(spark):
    plan = licenses.scan(spark.createDataFrame(NOTICES, "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)
