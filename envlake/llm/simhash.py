"""SimHash near-duplicates by a grid over segment bit counts.

Fingerprints are cut into segments; the bit counts of the segments are a point in a
grid. Two fingerprints that differ in d bits lie at most d apart in Manhattan distance,
so fingerprints within 2 bits share a grid cell at most one step from either. A cell
that only one fingerprint reaches proves it has no partner there: this lower bound
removes fingerprints without partners. For the rest, two fingerprints are within 2 bits
exactly if they share a word at most one flipped bit from either. All fingerprints that
share a word are linked to the smallest, so a group of n copies makes n links.

Null and empty texts have fingerprint zero and are linked like any other; repeated rows
and equal texts share a fingerprint. An empty table gives an empty result.

Near copies of the pipeline (``near_groups``) are linked by these fingerprints, and beyond
what two bits can reach by an exact join of shingle sets; groups of both are united.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm import overlap
from envlake.llm.components import contracted_components
from envlake.llm.tables import free_name, read_table, small_batches, written

SEED = 42
# Finer segments make a larger grid: with 2 bits, chance meetings of a hundred million texts stay rare.
SEGMENT_BITS = 2
# Shingles whose bits are unpacked at once; a long text is counted piece by piece.
PIECE = 255 << 5
# Ids that are broadcast to the texts: eight megabytes at most.
BROADCAST_IDS = 1 << 20
# Fingerprints whose cells one task makes.
TASK_ROWS = 1 << 16


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle, repeats included; of the whole sequence if it has fewer words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    hashes = (xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles)
    return np.fromiter(hashes, np.uint64, max(1, len(words) - width + 1))


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Per column of (n, k) hashes, the integer of the bits that are set in over half the rows."""
    rows, columns = hashes.shape
    ones = np.zeros(64 * columns, np.int64)
    for at in range(0, rows, PIECE):
        bits = np.unpackbits(np.ascontiguousarray(hashes[at : at + PIECE]).view(np.uint8), axis=1, bitorder="little")
        # Sums of 255 bits fit a byte.
        whole = len(bits) // 255 * 255
        ones += bits[whole:].sum(axis=0, dtype=np.uint8)
        ones += bits[:whole].reshape(-1, 255, 64 * columns).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > rows, bitorder="little").view(np.uint64)


def text_fingerprint(text: str | None, width: int) -> int:
    """64-bit fingerprint of the shingles; zero without words."""
    hashes = _shingle_hashes(text, width)
    return int(_majority(hashes[:, None])[0]) if len(hashes) else 0


def fingerprints(documents: DataFrame, width: int, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit integer, beside its ``ids``."""
    small_batches(documents.sparkSession)
    names = [*ids, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(text_fingerprint(text.as_py(), width)) for text in batch.column(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names)

    kept = [F.col(name).cast("bigint").alias(name) for name in ids]
    return documents.select(*kept, "text").mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def _lanes(segment_bits: int) -> list[int]:
    return list(range(0, 64, segment_bits))


def grid_point(fp: Column, segment_bits: int) -> Column:
    """Bit count of every segment, packed in one integer with a lane per segment."""
    ones = (1 << segment_bits) - 1
    counts = [
        F.shiftleft(F.bit_count(fp.bitwiseAND(F.lit(_signed(ones << lane)))).cast("bigint"), lane) for lane in _lanes(segment_bits)
    ]
    point = counts[0]
    for count in counts[1:]:
        point = point.bitwiseOR(count)
    return point


def _cells(point: Column, segment_bits: int) -> Column:
    """The cell of a point and those one step away, inside the grid."""
    cells = [point]
    ones = (1 << segment_bits) - 1
    for lane in _lanes(segment_bits):
        count = F.shiftrightunsigned(point, lane).bitwiseAND(F.lit(ones))
        others = point.bitwiseAND(F.lit(_signed((1 << 64) - 1 - (ones << lane))))
        cells += [
            F.when(count < segment_bits, others.bitwiseOR(F.shiftleft(count + 1, lane))),
            F.when(count > 0, others.bitwiseOR(F.shiftleft(count - 1, lane))),
        ]
    return F.array_compact(F.array(*cells))


def _words(fp: Column) -> Column:
    """The fingerprint and its 64 neighbours at one flipped bit."""
    return F.array(fp, *(fp.bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64)))


def links(distinct: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """Links (u, v) that join all fingerprints (fp), each given once, within 2 bits of each other."""
    cells = distinct.select("fp", F.explode(_cells(F.col("point"), segment_bits)).alias("cell"))
    # The cells of a fingerprint differ, so one counted twice is reached by two. Their list is
    # written: the cells travel once, and a short list goes to them.
    shared = written(cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1").select("cell"), "simhash-cells")
    near = written(cells.join(_small_or_shuffled(shared), "cell", "left_semi").select("fp").distinct(), "simhash-near")
    words = near.select("fp", F.explode(_words(F.col("fp"))).alias("word"))
    hubs = words.groupBy("word").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")).filter("hub <> last").select("word", "hub")
    return words.join(hubs, "word").filter("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()


def _rooted(rows: DataFrame, segment_bits: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint of written rows: the smallest one reachable by links."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    # A fingerprint has tens of cells: few rows are much work.
    distinct = written(rows.select("fp").distinct().repartition(tasks), "simhash-distinct")
    found = links(distinct.select("fp", grid_point(F.col("fp"), segment_bits).alias("point")), segment_bits)
    roots = written(contracted_components(written(found, "simhash-links")), "simhash-roots")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, width: int = 3, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """One row per row of documents: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id)."""
    if segment_bits not in (2, 4, 8):
        raise ValueError("segment_bits must be 2, 4 or 8")
    rows = written(fingerprints(documents, width), "simhash-fingerprints")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = firsts.join(_rooted(rows, segment_bits), "fp")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    membership = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(membership, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _small_or_shuffled(ids: DataFrame) -> DataFrame:
    """A list of ids of bounded size goes to the texts; a longer one is shuffled with them."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def similar_groups(documents: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, component_id) per row: groups linked at a similarity of 0.8 of the sets of shingles.

    The links are those of the exact join of sets. Rows without words are one group.
    """
    groups = written(overlap.joined(documents, width), "simhash-similar")
    wordless = groups.filter("n_shingles = 0").agg(F.min("doc_id")).first()[0]
    return groups.select(
        "doc_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.lit(wordless).cast("bigint")).alias("component_id")
    )


def near_groups(documents: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, component_id) per row: groups linked by fingerprints, or at a similarity of 0.8 of the sets of shingles.

    Fingerprints within 2 bits are linked as in ``near_duplicates``. Most texts at a similarity
    of 0.8 differ in more, so the exact join of sets adds its links, and groups that share a row
    are one. A row is known by id and text: neither rows that repeat an id nor those without id
    link what their texts do not. Rows without words have fingerprint zero and are one group.
    """
    keyed = documents.select(F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")).alias("row_key"), "doc_id", "text")
    rows = written(fingerprints(keyed, 3, ("row_key", "doc_id")), "simhash-fingerprints")
    by_print = rows.join(_rooted(rows, SEGMENT_BITS), "fp").select("row_key", "doc_id", "root")
    by_set = similar_groups(keyed.select(F.col("row_key").alias("doc_id"), "text"), width)
    by_set = by_set.select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("part")).distinct()
    rows = written(by_print.join(by_set, "row_key"), "simhash-both")
    hubs = rows.groupBy("root").agg(F.min("part").alias("hub"), F.max("part").alias("last")).filter("hub <> last")
    shared = rows.join(hubs, "root").filter("part <> hub").select(F.col("part").alias("u"), F.col("hub").alias("v")).distinct()
    united = written(contracted_components(written(shared, "simhash-shared")), "simhash-united")
    rows = rows.join(united.select(F.col("node").alias("part"), F.col("root").alias("root_of")), "part", "left").select("doc_id", F.coalesce("root_of", "part").alias("part"))
    least = rows.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return written(rows.join(least, "part").select("doc_id", "component_id"), "simhash-groups")


def drop_near_duplicates(documents: DataFrame, width: int = 5) -> DataFrame:
    """Documents without near copies: of each group the row with the smallest doc_id stays.

    Of rows that repeat an id and its text, one stays. Rows without id go if every one of
    them has a copy with an id, else they stay, equal texts once.
    """
    groups = near_groups(documents, width)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    per_id = written(groups.groupBy("doc_id").agg(F.max(stays).alias("stays"), F.count("*").alias("n")), "simhash-ids")
    name = free_name("other_id", documents.columns)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(name))
    gone = _small_or_shuffled(per_id.filter(~F.col("stays")).select(F.col("doc_id").alias(name)))
    left = documents.join(gone, same, "left_anti")
    # Ids are rarely repeated; only those rows are compared.
    repeated = _small_or_shuffled(per_id.filter(F.col("stays") & (F.col("n") > 1)).select(F.col("doc_id").alias(name)))
    several = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(several)


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, at most 2 differing bits."""
    return near_duplicates(read_table(spark, folder, "documents"))
