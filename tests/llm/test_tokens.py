"""The rank table gives the ids of the tokenizer's own library."""

from __future__ import annotations

import random

import public_tokenizers
from edge import rows
from tokenizers import Tokenizer

from envlake.llm import tokens


def test_ids_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, kind = tokens.tokenizer_cache(path)
    assert isinstance(own, tokens.RankEncoder)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    draw = random.Random(1)
    texts = [text for _, text, *_ in rows() if text is not None]
    texts += ["<|endoftext|>", "a<|endoftext|> b", "it's WE'LL x'd 'tis", " x y　 z", "\x1c\x1d\x1e\x1f \x85 ​﻿", "  \n\n  a \t", "١٢٣ ⅷ ²³ x̂ é"]
    # Every character but surrogates, in company and beside letters.
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts += ["".join(f"a{chr(p)} {chr(p)}{chr(p)}1 " for p in points[at : at + 400]) for at in draw.sample(range(0, len(points), 400), 250)]
    texts += ["".join(f"a{chr(p)} {chr(p)}{chr(p)}1 " for p in points[at : at + 400]) for at in range(0, 0x3400, 400)]
    found = [b"".join(parts) for parts in own.of(texts)]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    import numpy as np

    assert [np.frombuffer(one, kind).tolist() for one in found] == want


def test_other_tokenizers_take_the_cache():
    assert tokens.rank_table(public_tokenizers.path("word_bpe_49k.json")) is None
