"""Jaccard join of shingle sets by T-occurrence search with DivideSkip.

Two sets of sizes a and b reach the similarity exactly if they share T(a, b) shingles. In
an order common to all sets, frequent shingles last, the inverted lists of a set's first
shingles are its short lists, those of the others its long ones. Sets that share T have
``needed`` short lists in common at least, so a search merges the short lists of a set,
keeps what occurs often enough, and probes the long ones for what is left by binary search.

* Equal sets are one node; every row of documents belongs to one.
* The order comes from a count over all sets: what stands often in a task's sets is summed
  over the tasks, and the most frequent ``ORDERED`` shingles stand last. Any order gives
  the same result.
* Short lists are dealt by shingle, frequent ones over several partitions by node too, and
  a list of one set ends there. Within a partition they are read as a sorted stream.
* First every set of a list is compared with one hub of the list, which joins large groups
  of copies in a number of comparisons linear in the lists. Only sets that are not in one
  component yet are compared with each other: lists are cut into blocks, and a pair of
  blocks is one row group, whose sizes, places, components and parities are compared at
  once. Only pairs that pass all these necessary conditions become occurrences.
* Occurrences travel as sorted lists of nodes; a task heap-merges those of a set.

No pair is left out and every link is an exact comparison, so the components are whole.
Shingles are compared by 64-bit hashes, sets by 64-bit hashes of theirs. Documents without
words (null, empty, white space) have the empty set and are alone. Rows that repeat an id
are rows of their own; a row without id takes the component of its set, which is null if
no row there has an id. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.components import contracted_components
from envlake.llm.tables import free_name, read_table, small_batches, written
from envlake.llm.tokens import per_process

WIDTH = 5
# Similarity as a fraction: 80 of 100.
PART, WHOLE = 80, 100
SEED = 42
# Shingles that a task counts at once, how often one must stand there, and how many are put last.
COUNTED, OFTEN, ORDERED = 1 << 20, 4, 1 << 18
# A list expected to be longer is dealt over several partitions.
LIST_ROWS = 4096
# Members compared at once in a pair of blocks, and pairs whose parities are unpacked at once.
BLOCK, PAIRS = 2048, 1 << 15
# Sets of up to this many shingles need one list in common; each further such number needs one more.
PER_LIST = 128
PARITIES = 2048
# Members of a list, and comparisons per member, that need no further hubs first; turns of hubs at most, and hubs per list in each.
MUCH, TURNS, HUBS = 16, 2, 4
# Occurrences merged at once.
MERGED = 1 << 20
BROADCAST_IDS = 1 << 20


class WordHashes(dict):
    """Hashes of words met lately; a bounded number of words of bounded length is kept."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            if len(self) >= 1 << 17:
                self.clear()
            self[word] = found
        return found


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the different ``width``-word shingles, of the whole sequence if it has fewer words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    known = per_process(("words", SEED), WordHashes)
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(own) < width:
        return mixed([own[k : k + 1] for k in range(len(own))])
    return np.unique(mixed([own[k : len(own) - width + 1 + k] for k in range(width)]))


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several, place by place: a polynomial with odd factors, then scrambled."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        total = (total ^ column) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def overlap(a, b):
    """Shingles that sets of sizes a and b share at least if they link."""
    return -(-PART * (a + b) // (PART + WHOLE))


def needed(size):
    """Short lists that a set of a size shares with any set that links to it."""
    return 1 + size // PER_LIST


def short_lists(size):
    """How many lists of a set are short."""
    # The smallest set that may link.
    least = -(-PART * size // WHOLE)
    return size and min(size, size - overlap(size, least) + needed(size))


def may_link(a_size, a_at, b_size, b_at):
    """Whether sizes, and the places of one shared shingle, allow a link."""
    small, large = np.minimum(a_size, b_size), np.maximum(a_size, b_size)
    shared = 1 + np.minimum(a_at, b_at) + np.minimum(a_size - a_at, b_size - b_at) - 1
    # The smaller set needs its first lists only.
    small_at = np.where(a_size <= b_size, a_at, b_at)
    equal = (a_size == b_size) & (np.maximum(a_at, b_at) >= a_size - overlap(a_size, a_size) + needed(a_size))
    short = small_at < small - overlap(small, small) + needed(small)
    return (WHOLE * small >= PART * large) & (shared >= overlap(small, large)) & short & ~equal


def _node(own: np.ndarray) -> int:
    value = xxhash.xxh3_64_intdigest(own.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def parities(own: np.ndarray) -> bytes:
    """A bit per class of hashes, set if the set has an odd number of the class: sets differ in as many shingles as bits, or more."""
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _texts(documents: DataFrame, batch: int = 256) -> DataFrame:
    small_batches(documents.sparkSession, batch)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def sized(documents: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, node, size) of documents, and, apart from them, rows (shingle, n): how often some stand in a task's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def counted() -> pa.RecordBatch:
            shingles, n = np.unique(np.concatenate(held), return_counts=True)
            shingles, n = shingles[n >= OFTEN], n[n >= OFTEN]
            nothing = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([nothing, nothing, nothing.cast(pa.int32()), pa.array(shingles.view(np.int64)), pa.array(n)], names)

        names = ["doc_id", "node", "size", "shingle", "n"]
        for batch in batches:
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            nothing = pa.nulls(len(sets), pa.int64())
            nodes, sizes = pa.array(map(_node, sets), pa.int64()), pa.array(map(len, sets), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), nodes, sizes, nothing, nothing], names)
            held += sets
            count += sum(map(len, sets))
            if count >= COUNTED:
                yield counted()
                held, count = [], 0
        if held:
            yield counted()

    return _texts(documents).mapInArrow(run, "doc_id bigint, node bigint, size int, shingle bigint, n bigint")


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts: a list of bounded length."""
    counts = rows.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "shingle").limit(ORDERED).toPandas()
    shingles, n = found["shingle"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(shingles)
    return shingles[order], n[order]


def postings(documents: DataFrame, width: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shingle, salt, node, place): the short lists; place packs the size of the set and the place of the shingle in it."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = shared.value
        seen: set[int] = set()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, width)
                if not len(own) or (node := _node(own)) in seen:
                    continue
                seen.add(node)
                n = np.zeros(len(own), np.int64)
                if len(shingles):
                    at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
                    n = np.where(shingles[at] == own, counts[at], 0)
                first = np.argsort(n, kind="stable")[: short_lists(len(own))]
                split = 1 + n[first] // LIST_ROWS
                columns[0].append(own[first].view(np.int64))
                columns[1].append(np.where(split > 1, (node & 0x7FFFFFFF) % split, -1))
                columns[2].append(np.full(len(first), node))
                columns[3].append((len(own) << 32) + np.arange(len(first)))
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], ["shingle", "salt", "node", "place"])

    return _texts(documents, 1024).mapInArrow(run, "shingle bigint, salt bigint, node bigint, place bigint")


def lists(rows: DataFrame) -> DataFrame:
    """(shingle, node, size, at) of the short lists that hold several sets, or may do so in another partition."""
    names = ["shingle", "node", "size", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for what follows it; beside: whether its list began before it.
        waiting, beside = [np.empty(0, np.int64)] * 4, False
        for batch in itertools.chain(batches, [None]):
            parts = waiting if batch is None else [np.concatenate([w, c.to_numpy()]) for w, c in zip(waiting, batch.columns, strict=True)]
            if not len(parts[0]):
                continue
            own = parts[:3]
            first = np.r_[True, np.logical_or.reduce([p[1:] != p[:-1] for p in own])]
            shingle, salt, node, place = parts = [p[first] for p in parts]
            left = np.r_[beside, (shingle[1:] == shingle[:-1]) & (salt[1:] == salt[:-1])]
            stays = left | np.r_[left[1:], False] | (salt >= 0)
            if batch is not None:
                waiting, beside = [p[-1:] for p in parts], bool(left[-1])
                stays[-1] = False
            at = np.flatnonzero(stays)
            columns = [shingle[at], node[at], (place[at] >> 32).astype(np.int32), (place[at] & 0xFFFFFFFF).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    dealt = rows.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "node")
    return dealt.mapInArrow(run, "shingle bigint, node bigint, size int, at int")


def _small_or_shuffled(ids: DataFrame) -> DataFrame:
    """A list of ids of a counted, bounded size is broadcast; a longer one is shuffled."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def sets_of(documents: DataFrame, firsts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, size, shingles, odd) of some nodes, read again from the first document of each."""
    name = free_name("wanted_id", documents.columns)
    wanted = firsts.join(nodes, "node", "left_semi").select(F.col("first_id").alias(name)).distinct()
    wanted = _small_or_shuffled(written(wanted, "overlap-ids"))
    chosen = documents.join(wanted, F.col("doc_id").cast("bigint").eqNullSafe(F.col(name)), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(map(_node, sets), pa.int64()),
                    pa.array(map(len, sets), pa.int32()),
                    pa.array([own.astype("<u8").tobytes() for own in sets], pa.binary()),
                    pa.array(map(parities, sets), pa.binary()),
                ],
                ["node", "size", "shingles", "odd"],
            )

    sets = _texts(chosen).mapInArrow(run, "node bigint, size int, shingles binary, odd binary")
    # A repeated id can stand for other texts, and for equal ones.
    sets = written(sets.join(_small_or_shuffled(nodes), "node", "left_semi"), "overlap-sets")
    if sets.groupBy("node").count().filter("count > 1").head(1):
        sets = written(sets.dropDuplicates(["node"]), "overlap-sets")
    return sets


def shares(short: np.ndarray, long: np.ndarray, least: int) -> bool:
    """Whether sorted sets have at least so many members in common: the members of one are probed in the other while that is open."""
    found, step = 0, 256
    for begin in range(0, len(short), step):
        own = short[begin : begin + step]
        at = np.minimum(np.searchsorted(long, own), len(long) - 1)
        found += int((long[at] == own).sum())
        if found >= least or found + len(short) - begin - len(own) < least:
            break
    return found >= least


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, mine, theirs = (c.to_pylist() for c in batch.columns)
        keep = []
        for one, other in zip(mine, theirs, strict=True):
            one, other = np.frombuffer(one, "<u8"), np.frombuffer(other, "<u8")
            small, large = (one, other) if len(one) <= len(other) else (other, one)
            keep.append(shares(small, large, overlap(len(small), len(large))))
        chosen = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["u", "v"])


def _differ_little(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a_odd, b_odd = (np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(-1, PARITIES // 64) for c in batch.columns[4:])
        total = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
        chosen = pa.array(_few_bits(a_odd, b_odd, total))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["a", "b"])


def _few_bits(a_odd: np.ndarray, b_odd: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether parities differ in no more bits than linked sets of these sizes, in sum, differ in shingles."""
    return np.bitwise_count(a_odd ^ b_odd).sum(axis=1, dtype=np.int64) <= total - 2 * overlap(total, 0)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) among pairs (a, b) of nodes: parities first, then the sets themselves."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("size").alias(f"{side}_size"), F.col("odd").alias(f"{side}_odd")), side)
    pairs = pairs.select("a", "b", "a_size", "b_size", "a_odd", "b_odd").mapInArrow(_differ_little, "a bigint, b bigint")
    pairs = written(pairs, "overlap-likely")
    for side, name in (("a", "mine"), ("b", "theirs")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(name)), side)
    return written(pairs.select("a", "b", "mine", "theirs").mapInArrow(_probed, "u bigint, v bigint"), "overlap-links")


def _with_hubs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (a, b) of a set and a hub of one of its lists, and in how many lists they meet."""
    both = members.join(hubs, "shingle").filter(F.col("node") != F.col("hub.node"))
    size, other = F.col("size").cast("bigint"), F.col("hub.size").cast("bigint")
    shared = F.least("at", "hub.at") + F.least(F.col("size") - F.col("at"), F.col("hub.size") - F.col("hub.at"))
    fits = (WHOLE * F.least(size, other) >= PART * F.greatest(size, other)) & ((PART + WHOLE) * shared.cast("bigint") >= PART * (size + other))
    near = both.filter(fits).groupBy("node", F.col("hub.node").alias("other")).agg(F.count("*").alias("n"))
    return near.select("node", "other", F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "n")


def _hub(order: Column, name: str = "hub") -> Column:
    return F.min_by(F.struct("node", "size", "at"), F.struct(order, F.col("node"))).alias(name)


def block_rows(members: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of open lists, once per pair of blocks that they belong to; in long lists with their parities."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK))
    own = F.pmod("node", "blocks")
    dealt = members.join(sizes.select("shingle", "n", blocks.alias("blocks")), "shingle").withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("shingle", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.col("block").alias("side"), "node", "root", "size", "at", "n")
    odd = sets.select("node", "odd")
    long = dealt.filter(F.col("n") > MUCH).join(odd, "node")
    return long.unionByName(dealt.filter(F.col("n") <= MUCH).withColumn("odd", F.lit(None).cast("binary"))).drop("n")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows sorted by their first columns, a table of whole runs at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        if not len(batch):
            continue
        changes = np.logical_or.reduce([np.diff(c.to_numpy()) != 0 for c in batch.columns[:keys]])
        last = np.flatnonzero(changes)
        table = pa.Table.from_batches([batch])
        if held:
            before = held[-1]
            joined = all(before.column(k)[len(before) - 1] == table.column(k)[0] for k in range(keys))
            if not joined:
                yield pa.concat_tables(held)
                held = []
        if len(last):
            cut = int(last[-1]) + 1
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held = [table.slice(cut)]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, size, ys): per list and set, the sets of lesser number that may link to it, in order."""
    for table in _runs(batches, 3):
        table = table.combine_chunks()
        shingle, low, high, side, node, root, size, at = (table.column(k).to_numpy() for k in range(8))
        size, at = size.astype(np.int64), at.astype(np.int64)
        run = np.cumsum(np.r_[0, (np.diff(shingle) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)])
        crossed = low != high
        odd = table.column(8).to_pylist()
        longest = int(np.bincount(run).max())
        found: list[list[np.ndarray]] = [[], [], [], []]
        for shift in range(1, longest):
            i = np.flatnonzero(run[shift:] == run[:-shift])
            j = i + shift
            keep = (root[i] != root[j]) & (~crossed[i] | (side[i] != side[j])) & may_link(size[i], at[i], size[j], at[j])
            i, j = i[keep], j[keep]
            for begin in range(0, len(i), PAIRS):
                a, b = i[begin : begin + PAIRS], j[begin : begin + PAIRS]
                held = np.array([odd[k] is not None for k in a.tolist()], bool)
                if held.any():
                    fits = ~held
                    one, other = (np.frombuffer(b"".join(odd[k] for k in s[held].tolist()), np.uint64).reshape(-1, PARITIES // 64) for s in (a, b))
                    fits[held] = _few_bits(one, other, size[a[held]] + size[b[held]])
                    a, b = a[fits], b[fits]
                swapped = node[a] < node[b]
                x, y = np.where(swapped, b, a), np.where(swapped, a, b)
                for column, values in zip(found, (run[x], node[x], size[x], node[y]), strict=True):
                    column.append(values)
        if not found[0]:
            continue
        lists_of, x, sizes, y = (np.concatenate(c) for c in found)
        if not len(x):
            continue
        order = np.lexsort((y, x, lists_of))
        lists_of, x, sizes, y = lists_of[order], x[order], sizes[order], y[order]
        first = np.flatnonzero(np.r_[True, (np.diff(lists_of) != 0) | (np.diff(x) != 0)])
        ys = pa.ListArray.from_arrays(np.r_[first, len(y)].astype(np.int32), pa.array(y.astype(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(x[first]), pa.array(sizes[first]), ys], ["x", "size", "ys"])


def divide_skip(found: list[np.ndarray], least: int) -> list[int]:
    """Members of at least so many sorted lists: short lists are merged by a heap, the longest probed for what is left."""
    found = sorted(found, key=len)
    short, long = found[: len(found) - (least - 1)], found[len(found) - (least - 1) :]
    kept = []
    for node, same in itertools.groupby(heapq.merge(*(own.tolist() for own in short))):
        count = sum(1 for _ in same)
        for own in long:
            if count >= least:
                break
            at = int(np.searchsorted(own, node))
            count += at < len(own) and int(own[at]) == node
        if count >= least:
            kept.append(node)
    return kept


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _runs(batches, 2):
        x, size = table.column(0).to_numpy(), table.column(2).to_numpy()
        starts = np.flatnonzero(np.r_[True, (np.diff(x) != 0) | (np.diff(table.column(1).to_numpy()) != 0)]).tolist()
        ys = table.column(3).combine_chunks()
        offsets, values = ys.offsets.to_numpy(), ys.values.to_numpy()
        a, b = [], []
        for begin, end in zip(starts, [*starts[1:], len(x)], strict=True):
            own = [values[offsets[k] : offsets[k + 1]] for k in range(begin, end)]
            least = int(needed(-(-PART * int(size[begin]) // WHOLE)))
            if len(own) >= least:
                kept = divide_skip(own, least)
                b += kept
                a += [int(x[begin])] * len(kept)
        # The lesser node first, as everywhere.
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(a, pa.int64())], ["a", "b"])


def occurring(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that occur in enough lists, of rows made by ``block_rows``."""
    keys = ["shingle", "low", "high"]
    ordered = rows.select(*keys, "side", "node", "root", "size", "at", "odd").repartition(*keys).sortWithinPartitions(*keys)
    met = written(ordered.mapInArrow(_met, "x bigint, size bigint, ys array<bigint>"), "overlap-met")
    most = met.groupBy("x").agg(F.sum(F.size("ys")).alias("n")).agg(F.max("n")).first()[0] or 0
    shards = max(1, -(-most // MERGED))
    if shards > 1:
        # Occurrences of one partner stay together.
        met = met.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        met = met.withColumn("ys", F.expr(f"filter(ys, y -> pmod(y, {shards}) = shard)")).filter(F.size("ys") > 0)
    else:
        met = met.withColumn("shard", F.lit(0))
    met = met.select("x", F.col("shard").cast("bigint").alias("shard"), "size", "ys").repartition("x", "shard").sortWithinPartitions("x", "shard")
    return met.mapInArrow(_merged, "a bigint, b bigint")


def joined(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row."""
    rows = written(sized(documents, width), "overlap-rows")
    common = frequent(rows)
    rows = rows.filter("shingle IS NULL").select("doc_id", "node", "size")
    firsts = rows.filter("size > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    members = written(lists(postings(documents, width, common)), "overlap-members")
    n_members = members.count()
    nodes = written(members.select("node").distinct(), "overlap-nodes")
    sets = sets_of(documents, firsts, nodes, width)

    near = _with_hubs(members, members.groupBy("shingle").agg(_hub(F.col("node"))))
    # Of several hubs the one met in most lists; the others are left for later.
    best = near.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("n", "other")).alias("pair"))
    compared = written(best.select("pair.a", "pair.b").distinct(), "overlap-pairs")
    found = verified(compared, sets)
    fresh = True
    for turn in range(1, TURNS + 2):
        roots = written(contracted_components(found), "overlap-roots")
        grouped = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        per_root = grouped.groupBy("shingle", "root").agg(F.count("*").alias("n"))
        per_list = per_root.groupBy("shingle").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
        open_lists = written(per_list.filter("roots > 1").select("shingle", "n", "main"), "overlap-open")
        if not open_lists.head(1):
            break
        # Short lists are compared whole; further hubs are for long ones.
        long = open_lists.filter(F.col("n") > MUCH)
        work = long.agg(F.sum((F.col("n") - F.col("main.n")) * F.col("n"))).first()[0] or 0
        last = work <= MUCH * n_members or not fresh or turn > TURNS
        inside = (open_lists if last else long).select("shingle", F.col("main.root").alias("main"))
        inside = written(grouped.join(inside, "shingle"), "overlap-inside")
        if last:
            rest = occurring(block_rows(inside.drop("main"), open_lists, sets))
            found = found.unionByName(verified(rest.join(compared, ["a", "b"], "left_anti"), sets))
            roots = contracted_components(found)
            break
        outside = inside.filter("root <> main")
        seeds = range(HUBS * turn, HUBS * (turn + 1))
        hubs = outside.groupBy("shingle").agg(*(_hub(F.xxhash64("node", F.lit(seed)), f"hub_{seed}") for seed in seeds))
        hubs = hubs.select("shingle", F.explode(F.array_distinct(F.array(*(f"hub_{seed}" for seed in seeds)))).alias("hub"))
        new = written(_with_hubs(inside, hubs).select("a", "b").distinct().join(compared, ["a", "b"], "left_anti"), "overlap-pairs")
        links = verified(new, sets)
        fresh = bool(links.head(1))
        compared, found = compared.unionByName(new), found.unionByName(links)

    rooted = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = rooted.join(least, "root").select("node", "component_id")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(of_node, "node", "left").select("doc_id", F.col("size").cast("bigint").alias("n_shingles"), own.alias("component_id"))


def op11_divide_skip(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by links of 0.8 or more in 5-word shingles."""
    return joined(read_table(spark, folder, "documents"))


OP11_SQL = r"""
WITH RECURSIVE split AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[ 	-
]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT r, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END) AS s
  FROM split WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM sets x JOIN sets y USING (s) WHERE x.r <> y.r GROUP BY ALL)
  JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT r, r AS other FROM split UNION SELECT reach.r, b FROM reach JOIN links ON a = other)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN split d ON d.r = reach.r JOIN split o ON o.r = other LEFT JOIN sizes ON sizes.r = d.r
GROUP BY d.r
"""
