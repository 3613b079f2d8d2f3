"""Immutable registry of raw batches."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.domain import SCHEMA_VERSION, SOURCE
from envlake.errors import ConflictError, InputError, is_missing_path
from envlake.functions import rules, variants
from envlake.operators.acquisition import (
    batch_path,
    batch_rules,
    normalized_boundary,
    register_batches,
    registration_summary,
)
from envlake.session import workspace
from envlake.sources.envelopes import RESOURCE

REGISTRY_DDL = "path string, content string, content_hash string, returned bigint, run_id string"
COMMIT_DDL = "number bigint, token string"
COMMIT_ATTEMPTS = 20
PAGINATION_DDL = (
    "struct<pages_fetched: bigint, requested_limit: bigint, found: string, "
    "pages: array<struct<page: bigint, meta: string, returned: bigint>>>"
)


def prepare_batches(batches: DataFrame) -> DataFrame:
    """Envelope, path and content digest of batches that keep their contract.

    batches: location_id, location_name, sensor_id, parameter, datetime_from,
    datetime_to, returned, found, incomplete, pagination_complete, source_meta,
    measurements (both JSON text); optionally pagination, null or a struct of
    pages_fetched, requested_limit, found (JSON text) and pages, an array of structs of
    page, meta (JSON text) and returned. Its facts then replace the batch's total.
    """
    if "pagination" not in batches.columns:
        batches = batches.withColumn("pagination", F.lit(None).cast(PAGINATION_DDL))
    counted = batches.withColumn(
        "records", F.size(F.from_json("measurements", "array<string>")).cast("bigint")
    )
    rules.require_clean(counted, batch_rules(), "raw batches")
    windowed = counted.withColumns(
        {name: normalized_boundary(F.col(name)) for name in ("datetime_from", "datetime_to")}
    )
    paged = F.col("pagination").isNotNull()
    members = ("location_id", "location_name", "sensor_id", "parameter", "datetime_from", "datetime_to", "returned")
    complete = F.lit(True).alias("complete")
    keep_nulls = {"ignoreNullFields": "false"}
    retrieval = F.when(
        paged,
        F.to_json(
            F.struct(
                *members,
                F.parse_json("pagination.found").alias("found"),
                complete,
                "pagination.pages_fetched",
                F.col("pagination.requested_limit").alias("requested_page_size"),
            ),
            keep_nulls,
        ),
    ).otherwise(F.to_json(F.struct(*members, "found", complete), keep_nulls))
    page = lambda p: F.struct(p["page"].alias("page"), F.parse_json(p["meta"]).alias("meta"), p["returned"].alias("returned"))
    pages = F.to_json(F.transform("pagination.pages", page), keep_nulls)
    content = F.concat(
        F.lit(f'{{"source":"{SOURCE}","resource":"{RESOURCE}","schema_version":{SCHEMA_VERSION},"retrieval":'),
        retrieval,
        F.lit(',"source_meta":'),
        F.coalesce("source_meta", F.lit("null")),
        F.when(paged, F.concat(F.lit(',"source_pages":'), pages)).otherwise(""),
        F.lit(',"measurements":'),
        F.col("measurements"),
        F.lit("}"),
    )
    path = batch_path(
        *map(F.col, ("location_id", "parameter", "sensor_id", "datetime_from", "datetime_to"))
    )
    return windowed.select(
        path.alias("path"), content.alias("content"), "returned"
    ).withColumn("content_hash", content_hash(F.col("content")))


def content_hash(content):
    """Digest of the JSON content, blind to member order and number spelling."""
    return F.sha2(variants.canonical_json(content), 256)


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """(number, token) of every commit; a token names a folder of batches."""
    try:
        return spark.read.schema(COMMIT_DDL).json(f"{path}/commits")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], COMMIT_DDL)


def read_registry(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Batches of all commits, or of those up to ``number``; what no commit names is not there."""
    live = _commits(spark, path)
    if number is not None:
        live = live.filter(F.col("number") <= number)
    try:
        rows = spark.read.schema(f"{REGISTRY_DDL}, token string").parquet(f"{path}/batches")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], REGISTRY_DDL)
    return rows.join(live.select("token"), "token", "left_semi").drop("token")


def _claim(spark: SparkSession, path: str, number: int, token: str) -> bool:
    """Make commit ``number`` name ``token``; False if another writer has made that commit.

    The commit is written aside and renamed; the file system refuses a name that exists.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = hadoop.Path(f"{path}/commits/{number:012d}.json")
    aside = hadoop.Path(f"{path}/commits/.{token}.json")
    files = hadoop.FileContext.getFileContext(target.toUri(), conf)
    system = target.getFileSystem(conf)
    stream = system.create(aside, False)
    stream.write(json.dumps({"number": number, "token": token}).encode())
    stream.close()
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(aside, target, no_overwrite)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def persist_run(
    spark: SparkSession,
    batches: DataFrame,
    registry_path: str,
    run_id: str,
    checkpoint_safe: bool | None = None,
) -> dict[str, int]:
    """Add the new batches of a run as one commit; refuse the whole run on any conflict.

    An incremental run passes whether its checkpoint is safe; an unsafe run is
    refused before anything is compared or written. Several runs may write at once: a run
    compares itself with a numbered state and commits the next number. If another run has
    taken that number, it compares itself anew, so a path is registered once. A
    run without new batches makes no commit.
    """
    if checkpoint_safe is False:
        raise InputError("The checkpoint of this run is unsafe; nothing was registered.")
    # Staged once: totals and rows to write are taken from the written batches.
    staged = workspace(spark, "register")
    prepare_batches(batches).write.parquet(staged)
    prepared = spark.read.parquet(staged)
    for _ in range(COMMIT_ATTEMPTS):
        number = _commits(spark, registry_path).agg(F.max("number")).first()[0] or 0
        registered = register_batches(prepared, read_registry(spark, registry_path, number))
        totals = registration_summary(registered).first()
        if totals.conflicts:
            first = registered.filter("status = 'conflict'").agg(F.min("path")).first()[0]
            raise ConflictError(f"Different content for the same raw path: {first}")
        if not totals.batches_written:
            break
        token = uuid.uuid4().hex
        fresh = registered.filter("status = 'written'").select("path")
        one_copy = (
            prepared.join(fresh, "path", "left_semi")
            .groupBy("path", "content_hash")
            # Equal digests are equal content, however it is spelled.
            .agg(F.first(F.struct("content", "returned")).alias("b"))
            .select("path", "b.content", "content_hash", "b.returned", F.lit(run_id).alias("run_id"))
        )
        one_copy.write.option("compression", "zstd").parquet(f"{registry_path}/batches/token={token}")
        if _claim(spark, registry_path, number + 1, token):
            break
    else:
        raise InputError(f"{COMMIT_ATTEMPTS} other runs committed first; nothing was registered.")
    return {
        "batches_written": totals.batches_written or 0,
        "batches_reused": totals.batches_reused or 0,
        "measurements_represented": totals.measurements_represented or 0,
    }
