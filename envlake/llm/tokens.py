"""Token ids of whole texts.

A byte-level vocabulary whose ids are the order of its merges is read into a rank table,
which encodes whole texts at once and gives the ids of the tokenizer in the file. With any
other tokenizer, parts of texts are looked up in a bounded cache: a single space between two characters that are not white space always begins a new
token: the splitting pattern of the vocabulary attaches it to what follows. So a text
is cut there, and the ids of the parts, one after another, are the ids of the text.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np

# Before a single space that has other characters than white space on both sides.
CUT = re.compile(r"(?<=\S)(?= \S)")


def cuts_of(text: str) -> list[str]:
    """The parts of a text, one by one."""
    return CUT.split(text)


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """A value that all tasks of a worker process share; it holds nothing that a lost worker takes along."""
    store = sys.modules.setdefault("_shared_by_tasks", types.ModuleType("_shared_by_tasks"))
    values = store.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


class PartCache:
    """What a function makes of parts of texts, for the parts met lately: two generations of bounded size."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = 400_000) -> None:
        self.make, self.limit = make, limit
        # By the part without the space it begins with; None where white space touches its ends.
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of(self, texts: list[str]) -> Iterator[list]:
        """Per text, the values of its parts."""
        split = [text.split(" ") for text in texts]
        young, old = self.young, self.old
        missing = []
        for part in set().union(*(parts[1:] for parts in split)) - young.keys():
            if part in old:
                young[part] = old[part]
            elif part and not part[0].isspace() and not part[-1].isspace():
                missing.append(part)
            else:
                young[part] = None
        if missing:
            young.update(zip(missing, self.make([" " + part for part in missing]), strict=True))
        heads = self.make([parts[0] for parts in split])
        for text, parts, head in zip(texts, split, heads, strict=True):
            first = parts[0]
            found = [head]
            found.extend(map(young.__getitem__, parts[1:]))
            if None in found or (len(found) > 1 and (not first or first[-1].isspace())):
                yield list(self.make(cuts_of(text)))
            else:
                yield found
        if len(young) > self.limit:
            self.young, self.old = {}, young


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def rank_table(path: str) -> dict[bytes, int] | None:
    """Ids by bytes, if the tokenizer in a file is plain byte-level BPE whose merges are in the order of ids."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, before = whole["model"], whole["pre_tokenizer"] or {}
    plain = not (whole["normalizer"] or whole["post_processor"] or model.get("ignore_merges"))
    plain &= model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    plain &= before.get("type") == "ByteLevel" and before.get("use_regex") is True and not before.get("add_prefix_space")
    symbols = byte_symbols()
    added = {one["id"] for one in whole["added_tokens"]}
    words = {word: number for word, number in model["vocab"].items() if number not in added}
    if not plain or any(c not in symbols for word in words for c in word):
        return None
    merged = [words.get("".join(pair if isinstance(pair, list) else pair.split(" "))) for pair in model["merges"]]
    if None in merged or merged != sorted(merged) or len(words) != 256 + len(merged):
        return None
    return {bytes(map(symbols.__getitem__, word)): number for word, number in words.items()}


class RankEncoder:
    """Ids of whole texts by a rank table."""

    def __init__(self, ranks: dict[bytes, int], kind: np.dtype) -> None:
        import public_tokenizers
        import tiktoken

        self.kind = kind
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def of(self, texts: list[str]) -> Iterator[list[bytes]]:
        """Per text, its ids in one part."""
        return ([np.array(self.encode(text), self.kind).tobytes()] for text in texts)


def tokenizer_cache(path: str) -> tuple[PartCache | RankEncoder, np.dtype]:
    """Encoder of texts to ids, as little-endian bytes of the returned type, by the tokenizer in a file; no special tokens."""

    def make() -> tuple[PartCache | RankEncoder, np.dtype]:
        ranks = rank_table(path)
        if ranks is None:
            return _tokenizer_cache(path)
        kind = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
        return RankEncoder(ranks, kind), kind

    return per_process(("tokenizer", path), make)


def _tokenizer_cache(path: str) -> tuple[PartCache, np.dtype]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def ids(texts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(parts: list[str]) -> list[bytes]:
        return [np.array(found, kind).tobytes() for found in ids(parts)]

    (line_end,) = ids(["\n"])
    ends = dict(zip((".", ","), encode([".", ","]), strict=True))

    def encode_spaced(parts: list[str]) -> list[bytes]:
        """Parts that begin with a space and hold no other: in one text, a line each."""
        (found,) = ids(["\n".join(parts)])
        found = np.array(found, kind)
        at = np.flatnonzero(found == line_end[0]).tolist()
        data, size = found.tobytes(), kind.itemsize
        return [data[size * begin : size * end] for begin, end in zip([0, *(a + 1 for a in at)], [*at, len(found)], strict=True)]

    def make(parts: list[str]) -> list[bytes]:
        # A full stop or comma after a letter or digit is a token of its own.
        bare = [part[:-1] if part[-1:] in ends and part[-2:-1].isalnum() else part for part in parts]
        distinct = list(dict.fromkeys(bare))
        spaced = [part for part in distinct if part[:1] == " " and len(part.split()) == 1 and len(part.strip()) == len(part) - 1]
        known = dict(zip(spaced, encode_spaced(spaced), strict=True)) if len(line_end) == 1 and spaced else {}
        others = [part for part in distinct if part not in known]
        known.update(zip(others, encode(others), strict=True))
        return [known[b] if len(b) == len(p) else known[b] + ends[p[-1]] for b, p in zip(bare, parts, strict=True)]

    return PartCache(make), kind
