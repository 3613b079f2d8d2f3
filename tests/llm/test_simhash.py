"""SimHash groups against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash

from envlake.llm import components as components_module, overlap, simhash
from envlake.llm.components import components

DOCS = "doc_id bigint, text string, source string"


def brute_fingerprint(text, width=3):
    words = []
    for word in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" "):
        if word:
            words.append(word)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(fingerprints, most=2):
    """Smallest doc_id reachable per row by links of at most ``most`` differing bits."""
    group = list(range(len(fingerprints)))
    for i, (_, a) in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j][1]).bit_count() <= most:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for g, (doc, _) in zip(group, fingerprints, strict=True):
        ids[g] = min(ids.get(g, doc), doc)
    return [ids[g] for g in group]


def texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(draw.choices(words, k=draw.choice((0, 1, 2, 5, 60)))), "s") for k in range(n)]
    # Near copies: long texts with one word changed, in chains.
    for k in range(n, 2 * n):
        base = draw.choice(rows)[1].split()
        if base:
            base[draw.randrange(len(base))] = draw.choice(words)
        rows.append((k, " ".join(base), "s"))
    return [*rows, (2 * n, None, None), (2 * n + 1, " \t\n", "s"), (2 * n + 2, "A b C", "s"), (2 * n + 3, "a B c", "s"), rows[0]]


@pytest.mark.parametrize("segment_bits", [2, 4, 8])
def test_groups_equal_brute_force(spark, segment_bits):
    rows = texts(segment_bits, 60)
    want = [(doc, brute_fingerprint(text)) for doc, text, _ in rows]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS), segment_bits=segment_bits).collect()
    expected = sorted((doc, f"{fp:016x}", group) for (doc, fp), group in zip(want, brute_groups(want), strict=True))
    assert sorted(tuple(row) for row in found) == expected


def test_links_of_close_fingerprints(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(20)]
    points = set(base)
    for one in base:
        for _ in range(15):
            points.add(one ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) ^ draw.choice((0, 1 << 63, 1 << 62)))
    points = sorted(points)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in points], "fp bigint")
    frame = frame.withColumn("point", simhash.grid_point(frame.fp, 2))
    roots = {row.node: row.root for row in components(simhash.links(frame, 2)).collect()}
    want = brute_groups([(simhash._signed(p), p) for p in points])
    assert [roots.get(simhash._signed(p), simhash._signed(p)) for p in points] == want


def test_query_over_a_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = [(doc, brute_fingerprint(text)) for doc, text in rows]
    expected = sorted((doc, f"{fp:016x}", group) for (doc, fp), group in zip(want, brute_groups(want), strict=True))
    assert sorted(tuple(row) for row in simhash.op1_simhash_near_dedup(spark, folder).collect()) == expected


def test_drop_keeps_one_row_of_each_group_with_all_columns(spark):
    draw = random.Random(3)
    words = [f"v{k}" for k in range(3000)]
    base = [draw.choices(words, k=400) for _ in range(12)]
    rows = []
    for k, one in enumerate(base):
        rows.append((10 * k, " ".join(one), "a", 1))
        for copy in range(1, 4):
            near = list(one)
            near[100 * copy] = "changed"  # similarity 0.975
            rows.append((10 * k + copy, " ".join(near), "b", 2))
    rows += [rows[0], (999, None, None, 3), (1000, "", "c", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id string, signature int")
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    ids = sorted(row.doc_id for row in kept.collect())
    assert ids == [*(10 * k for k in range(12)), 999]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_similar_groups_link_what_is_similar(spark):
    """No link below the similarity, and nine of ten pairs at or above it in one group."""
    draw = random.Random(11)
    words = [f"u{k}" for k in range(5000)]
    table = []
    for base in range(60):
        original = draw.choices(words, k=300)
        table.append((len(table), " ".join(original)))
        for _ in range(4):
            copy = list(original)
            for _ in range(draw.randint(1, 9)):
                copy[draw.randrange(300)] = draw.choice(words)
            table.append((len(table), " ".join(copy)))
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    sets = {doc: set(zip(*(text.split()[k:] for k in range(5)), strict=False)) for doc, text in table}
    pairs = [(a, b) for a in sets for b in sets if a < b and a // 5 == b // 5]
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) > 150 and sum(found[a] == found[b] for a, b in near) >= 0.9 * len(near)
    linked = {(a, b) for a, b in near}
    for doc, group in found.items():
        if doc != group or sum(g == group for g in found.values()) > 1:
            assert any((min(doc, o), max(doc, o)) in linked for o in found if o != doc and found[o] == group)


def test_near_groups_link_fingerprints_whatever_the_sets_share(spark):
    """Few common words in another order: equal fingerprints at times, but sets of 5-word shingles below 0.8."""
    draw = random.Random(29)
    table, prints = [], {}
    while len(table) < 6:
        text = " ".join(["a b c"] * 60 + draw.choices(["x", "y", "z"], k=draw.randint(8, 20)))
        mine = simhash.text_fingerprint(text, 3)
        near = [doc for doc, other in prints.items() if (mine ^ other).bit_count() <= 2]
        if near or not table:
            prints[len(table)] = mine
            table.append((len(table), text))
    assert len(set(jaccard_groups(table).values())) > 1
    table += [(7, "quite another text"), (8, "of five words and one"), (7, table[0][1]), (None, table[1][1]), (None, "no id here at all")]
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(frame).collect()), key=str)
    want = [(doc, 0) for doc in range(6)] + [(7, 7), (8, 8), (7, 0), (None, 0), (None, None)]
    assert found == sorted(want, key=str)
    assert {row.doc_id for row in simhash.drop_near_duplicates(frame).collect()}.isdisjoint(range(1, 6))


@pytest.mark.parametrize("edges", [1 << 20, 4])
def test_fingerprint_links_are_contracted_by_tasks_first(spark, monkeypatch, edges):
    """Links of one task need no alternating rounds, and several tasks' give the same groups."""
    rounds, plain = [], components_module.components

    def counted(found):
        rounds.append(1)
        return plain(found)

    monkeypatch.setattr(components_module, "components", counted)
    monkeypatch.setattr(simhash, "components", counted, raising=False)
    monkeypatch.setattr(components_module, "TASK_EDGES", edges)
    # A chain, each within two bits of the next; far from it a pair and a single one.
    chain = [sum(1 << 2 * bit for bit in range(k)) for k in range(20)]
    others = [0x0FFF << 48, 0x0FFE << 48, 0xFFFF << 46]
    rows = spark.createDataFrame([(fp,) for fp in chain + others], "fp bigint").repartition(6)
    found = {r.fp: r.root for r in simhash._rooted(rows, 2).collect()}
    want = [0] * len(chain) + [others[1], others[1], others[2]]
    assert found == dict(zip(chain + others, want, strict=True))
    assert bool(rounds) == (edges < 10)


def jaccard_groups(table, width=5, similarity=0.8):
    """Smallest doc_id reachable per doc by links of exact Jaccard similarity."""
    sets = {doc: {" ".join(text.split()[k : k + width]) for k in range(max(1, len(text.split()) - width + 1))} for doc, text in table}
    group = {doc: doc for doc in sets}
    for a in sets:
        for b in sets:
            if a < b and group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= round(5 * similarity) * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {doc: low if g == high else g for doc, g in group.items()}
    return group


@pytest.mark.parametrize("much", [0, 4])
def test_near_copies_inside_a_family_of_similar_texts(spark, monkeypatch, much):
    """Texts at about 0.7 to each other, some of them with a copy at 0.8 or more."""
    monkeypatch.setattr(overlap, "MUCH", much)
    draw = random.Random(17)
    words = [f"f{k}" for k in range(5000)]
    shared, table = draw.choices(words, k=330), []
    for k in range(120):
        text = shared + draw.choices(words, k=70)
        table.append((len(table), " ".join(text)))
        if k % 3 == 0:
            table.append((len(table), " ".join([*text[: 400 - draw.randint(20, 60)], *draw.choices(words, k=12)])))
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    want = jaccard_groups(table)
    assert len(set(want.values())) < len(want) and len(set(want.values())) > 60
    assert found == want


def test_pairs_at_the_limit_are_linked_whatever_their_size(spark):
    """Eight words and the same with a ninth share four of five shingles; longer texts lie between 0.8 and 0.85."""
    draw = random.Random(23)
    words = [f"e{k}" for k in range(5000)]
    table = []
    for k in range(150):
        text = draw.choices(words, k=8 if k < 75 else 200)
        more = 1 if k < 75 else draw.randint(35, 49)
        table += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + draw.choices(words, k=more)))]
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    assert found == jaccard_groups(table) == {doc: doc // 2 * 2 for doc, _ in table}
