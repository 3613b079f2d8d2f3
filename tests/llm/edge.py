"""Rows that every operator over documents must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " score string, `kept_id` int, signature string, boilerplate_lines string, queue string, word string"
)


def rows(seed: int = 1, n: int = 30) -> list[tuple]:
    """Ordinary texts, empty and null ones, a very long one, ties, repeated rows and null columns; clashing names."""
    draw = random.Random(seed)
    words = ["the", "of", "and", "stone", "river,", "cloud.", "él", "größe", "x1", "don't"]
    made = [
        (k, "\n".join(" ".join(draw.choices(words, k=draw.randint(1, 12))) for _ in range(draw.randint(1, 6))), "en", f"s{k % 3}")
        for k in range(n)
    ]
    made += [
        (100, None, None, None),
        (101, "", "en", ""),
        (102, " \t\n ", "en", "s1"),
        (103, "word " * 60_000, "en", "s1"),
        (104, "a" * 30_000, "de", None),
        (105, made[0][1], "en", "s0"),
        (106, made[0][1], "en", "s0"),
        (None, "no id here", "en", "s2"),
        (107, "語 😀  double  space\r\n\x0b\x1c end ", None, "s2"),
    ]
    full = [(*row, len(row[1] or ""), "a", 1, None, "b", "c", "d") for row in made]
    return [*full, full[1], full[1], full[-2]]
