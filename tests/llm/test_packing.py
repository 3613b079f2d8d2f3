"""Packing: pieces rebuild the ids, sequences have no gaps, sources keep their shares."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge import SCHEMA, rows
from tokenizers import Tokenizer

from envlake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [np.array([*e.ids, 0], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(pieces, table):
    """Every id in exactly one piece, digests right, offsets gapless, only the last sequence short."""
    want, found = defaultdict(list), defaultdict(list)
    for (doc, text), ids in zip(table, ids_of([t for _, t in table]), strict=True):
        want[doc].append(ids)
    for p in pieces:
        found[p.doc_id].append(p)
    assert set(found) == set(want)
    for doc, copies in want.items():
        expected = defaultdict(int)
        for ids in copies:
            expected[len(ids)] += len(ids)
        got = defaultdict(int)
        for p in found[doc]:
            assert any(len(i) == p.doc_tokens and zlib.crc32(i[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for i in copies)
            got[p.doc_tokens] += p.length
        assert got == expected
        if len(copies) == 1:
            at = 0
            for p in sorted(found[doc], key=lambda p: p.start):
                assert p.start == at
                at += p.length
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for number, own in sequences.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == packing.SEQUENCE_TOKENS or (at < packing.SEQUENCE_TOKENS and number == max(sequences))
    return sequences


def test_edge_rows(spark):
    table = rows()
    pieces = packing.pack(spark.createDataFrame(table, SCHEMA).repartition(3), PATH).collect()
    check(pieces, [row[:2] for row in table])


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_query_over_a_table(spark):
    folder = "/root/testdata/sf0.001"
    pieces = packing.op2_mixture_packing(spark, folder).collect()
    table = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(pieces, [row[:2] for row in table])


@pytest.mark.parametrize("shares", [None, {"a": 0.5, "b": 0.3, "c": 0.2}])
def test_windows_hold_the_mixture(spark, shares):
    """Every window before the first source runs out is within a slot per source of the target."""
    table = [(k, f"word{k} " * 300, "abc"[k % 3]) for k in range(300)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string, source string").repartition(5)
    pieces = packing.pack(frame, PATH, shares).collect()
    check(pieces, [row[:2] for row in table])
    source = {doc: s for doc, _, s in table}
    totals, mixture = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        totals[source[p.doc_id]] += p.length
        mixture[p.sequence_id][source[p.doc_id]] += p.length
    target = shares or {s: n / sum(totals.values()) for s, n in totals.items()}
    until = int(min(totals[s] / target[s] for s in target) / packing.SEQUENCE_TOKENS) - 1
    assert until > 20
    for number in range(until):
        for s in target:
            assert abs(mixture[number][s] - target[s] * packing.SEQUENCE_TOKENS) <= 2 * packing.SLOT_TOKENS
    # Deficits carry over: over many windows the shares are met closely.
    for s in target:
        served = sum(mixture[number][s] for number in range(until))
        assert abs(served - target[s] * until * packing.SEQUENCE_TOKENS) <= 4 * packing.SLOT_TOKENS


def test_slots_must_fit(spark):
    with pytest.raises(ValueError, match="multiple"):
        packing.pack(spark.createDataFrame([], SCHEMA), PATH, slot_tokens=100)
