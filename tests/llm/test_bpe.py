"""Tree-reduced BPE against the public library, and round trips."""

from __future__ import annotations

import hashlib

import public_tokenizers
import tiktoken
from edge import SCHEMA, rows
from hypothesis import given, settings, strategies as st

from envlake.llm import bpe
from envlake.llm.tokens import PartCache, cuts_of

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODEC, SPLIT = bpe.text_codec(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def encode(text):
    return [one for match in SPLIT.findall(text) for one in CODEC.encode(match.encode())]


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0abeinst'.,1é語😀²"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_equals_the_library(text):
    ids = encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["aaaa", "ab", "a", "b", "the", "ing", "Ġ"]), max_size=120).map("".join))
def test_matches_without_breaks(text):
    assert encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60))
def test_join_is_the_monoid_of_encodings(left, right):
    assert CODEC.join(CODEC._tree(left) if left else [], CODEC._tree(right) if right else []) == CODEC._merge(left + right)


def test_every_token_encodes_to_itself():
    assert all(CODEC._merge(token) == [rank] for token, rank in CODEC.ranks.items())


def test_long_matches():
    for text in ("a" * 20_000, "ab" * 10_000, "." * 20_000, " " * 20_000):
        assert encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\x1c\xa0ab.,'"), max_size=25), max_size=8))
def test_parts_are_encoded_apart(texts):
    cache = PartCache(lambda parts: [encode(part) for part in parts], limit=5)
    assert [sum(found, []) for found in cache.of(texts)] == [encode(text) for text in texts]
    assert all("".join(cuts_of(text)) == text for text in texts)


def test_edge_rows(spark):
    table = rows()
    frame = spark.createDataFrame(table, SCHEMA)
    digest = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for doc, text, *_ in table:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((doc, len(ids), digest(" ".join(map(str, ids)).encode()), digest((text or "").encode())))
    found = [tuple(r) for r in bpe.round_trips(frame, PATH, public_tokenizers.PATTERN).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    ids = {r.doc_id: r.ids for r in bpe.encode_texts(frame, PATH, public_tokenizers.PATTERN).collect()}
    assert ids[107] == LIBRARY.encode_ordinary(next(t[1] for t in table if t[0] == 107)) and ids[100] == []
    assert bpe.round_trips(frame.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_query_over_a_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = bpe.op8_byte_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
