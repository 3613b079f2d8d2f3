"""Exact duplicates against brute force, and the cuckoo index by itself."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from edge import SCHEMA, rows
from hypothesis import given, settings, strategies as st

from envlake.llm import exact_dedup
from envlake.llm.cuckoo import CuckooIndex


def brute(table):
    groups = defaultdict(list)
    for doc, text in table:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    found = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        stays = True
        for doc in ids:
            found.append((doc, keep, len(ids), doc == keep and stays, hashlib.sha256(text.encode()).hexdigest()))
            stays = stays and doc != keep
    return sorted(found, key=repr)


def test_equals_brute_force(spark):
    table = rows()
    frame = spark.createDataFrame(table, SCHEMA)
    found = sorted((tuple(r) for r in exact_dedup.exact_duplicates(frame).collect()), key=repr)
    assert found == brute([row[:2] for row in table])
    assert exact_dedup.exact_duplicates(frame.limit(0)).collect() == []


def test_hot_text_sends_one_row_per_task(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "unhex(sha2(IF(id % 3 = 0, 'same', string(id)), 256)) AS digest").repartition(4)
    local = exact_dedup._combined(frame.selectExpr("digest", "doc_id AS keep_id", "1L AS copies"))
    assert local.count() == 2000 + 4
    index = {bytes(r.digest): (r.keep_id, r.copies) for r in exact_dedup.update_index(None, frame).collect()}
    assert len(index) == 2001 and (0, 1000) in index.values()


def test_index_takes_insertions_and_deletions(spark):
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    first = spark.createDataFrame([(digest("a"), 3), (digest("a"), 1), (digest("b"), 2)], "digest binary, doc_id bigint")
    index = exact_dedup.update_index(None, first)
    more = spark.createDataFrame([(digest("c"), 9)], "digest binary, doc_id bigint")
    gone = spark.createDataFrame([(digest("a"), 3), (digest("b"), 2), (digest("z"), 5)], "digest binary, doc_id bigint")
    after = {bytes(r.digest): (r.keep_id, r.copies) for r in exact_dedup.update_index(index, more, gone).collect()}
    assert after == {digest("a"): (1, 1), digest("c"): (9, 1)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 400)), max_size=1500))
def test_cuckoo_index_is_a_counter(steps):
    index, live = CuckooIndex(2), defaultdict(int)
    for insert, key in steps:
        digest = hashlib.sha256(str(key).encode()).digest()
        if insert:
            index.insert(digest, key)
            live[digest] += 1
        else:
            assert index.delete(digest) == (live[digest] > 0)
            live[digest] = max(0, live[digest] - 1)
        assert index.may_contain(digest) or not live[digest]
    assert {e[0]: e[2] for e in index.items()} == {d: n for d, n in live.items() if n}
    assert index.live == sum(n > 0 for n in live.values())


def test_overflow_resizes_from_stored_keys():
    index = CuckooIndex(2)
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(5000)]
    for k, digest in enumerate(digests):
        index.insert(digest, k)
    assert index.resizes > 5 and all(index.find(d)[1] == k for k, d in enumerate(digests))
    assert index.find(hashlib.sha256(b"other").digest()) is None
