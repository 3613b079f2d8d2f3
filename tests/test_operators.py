from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from envlake.domain import RUN_STAGES
from envlake.errors import ConflictError, InputError, QueryArgumentError, is_missing_path
from envlake.functions import instants, text
from envlake.functions.skew import lookup_join
from envlake.operators import acquisition, geography, routing, run_audit, serving
from envlake.sinks import registry
from envlake.sinks.registry import persist_run, read_registry


def test_lookup_join_keeps_one_copy_of_the_dimension(spark):
    facts = spark.range(200).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 9))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k bigint, n string")
    for how in ("left", "inner"):
        ours = lookup_join(facts, dim, "k", how).select("id", "k", "n")
        plain = facts.join(dim, "k", how).select("id", "k", "n")
        assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_large_dimensions_are_not_broadcast(spark):
    """Three million locations are beyond the threshold; hot keys are left to the runtime's skew handling."""
    locations = spark.range(3_000_000).selectExpr("id AS k", "concat('a rather long name of location ', id) AS n")
    plan = lookup_join(spark.range(1000).withColumnRenamed("id", "k"), locations, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and "Generate" not in plan
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_retrievals_with_bad_page_numbers_have_an_outcome(spark):
    pages = [("m", run, page, True, None, None, None, 1000 if page != 9 else 3, f"{run}-{page}") for run, numbers in {
        1: [0], 2: [1001], 3: [None, 1], 4: [1, 2], 5: [1, 1001], 6: [9],
    }.items() for page in numbers]
    ddl = (
        "resource string, run_id int, page bigint, results_ok boolean, meta_page string, meta_limit string, meta_found string,"
        " returned bigint, content_hash string"
    )
    found = {r.run_id: (r.status, r.pages_fetched) for r in acquisition.audit_pages(spark.createDataFrame(pages, ddl)).collect()}
    assert found == {
        1: ("inconsistent_page_number", 0),
        2: ("page_limit_exceeded", 0),
        3: ("inconsistent_page_number", 0),
        4: ("incomplete", 2),
        5: ("page_limit_exceeded", 1),
        6: ("inconsistent_page_number", 9),
    }
    short = {r.run_id: r.status for r in acquisition.audit_pages(spark.createDataFrame(pages, ddl), max_pages=2).collect()}
    assert short[4] == "page_limit_exceeded" and len(short) == 6


def test_registry_with_a_path_held_twice(spark):
    incoming = spark.createDataFrame([("a", "1", 10), ("b", "2", 5)], "path string, content_hash string, returned bigint")
    known = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("b", "3")], "path string, content_hash string")
    found = {r.path: (r.status, r.batches_reused, r.measurements) for r in acquisition.register_batches(incoming, known).collect()}
    assert found["a"] == ("reused", 1, 10) and found["b"][0] == "conflict"


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    assert read_registry(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(AnalysisException) as found:
        spark.sql("SELECT * FROM no_such_table_here")
    assert not is_missing_path(found.value)


@pytest.mark.parametrize(
    "spelled, expected",
    [
        ("20260901T000000Z", "2026-09-01 00:00:00"),
        ("2026-09-01T07Z", "2026-09-01 07:00:00"),
        ("2026-09-01T00:00:00,5Z", "2026-09-01 00:00:00.5"),
        ("2026-09-01T0105Z", "2026-09-01 01:05:00"),
        ("2026-09-01T01:02:03 UTC", "2026-09-01 01:02:03"),
        ("20260901 010203+0200", "2026-08-31 23:02:03"),
        ("2026-09-01T00:00:00", None),
        ("2026-9-1T00:00:00Z", None),
        ("20261301T000000Z", None),
    ],
)
def test_iso_spellings(spark, spelled, expected):
    instant = spark.createDataFrame([(spelled,)], "t string").select(instants.parse_instant(F.col("t")).cast("string")).first()[0]
    assert instant == expected


def brute_force_run(events):
    """The update rules applied one event at a time."""
    run = None
    refused = 0
    for e in events:
        kind = e["kind"]
        if kind == "start":
            run = run or dict(status="running", stage="validate_run_config", failed=None, done=None, n=None, at=e["at"])
            continue
        if run is None:
            refused += 1
        elif kind == "stage":
            n = run["n"] if e["stage"] == "build_dbt_analytics" else None
            run.update(status="running", stage=e["stage"], failed=None, done=None, n=n)
        elif kind == "count" and run["status"] == "running":
            run["n"] = e["observations"]
        elif kind == "succeed" and run["status"] in ("running", "succeeded"):
            run.update(status="succeeded", done=run["done"] or e["at"], failed=None)
        elif kind == "fail" and run["status"] in ("running", "failed"):
            run.update(status="failed", failed=e["stage"] or run["stage"], done=run["done"] or e["at"])
        else:
            refused += 1
    return run, refused


@pytest.mark.parametrize("width", [1, 4, 100_000])
def test_run_fold_equals_brute_force(spark, width):
    rng = random.Random(3)
    rows, expected = [], {}
    for r in range(60):
        events = []
        for seq in range(rng.randint(1, 14)):
            kind = rng.choice(["start", "stage", "stage", "count", "succeed", "fail"])
            stage = rng.choice(RUN_STAGES) if kind == "stage" or (kind == "fail" and rng.random() < 0.5) else None
            if kind == "stage" and rng.random() < 0.4:
                stage = "build_dbt_analytics"
            events.append(dict(kind=kind, stage=stage, observations=seq if kind == "count" else None, at=seq + 1))
            rows.append(
                ("d", f"r{r}", seq, seq + 1, kind, stage, seq if kind == "count" else None)
                + (("historical", "2024-01-01", "2024-01-02", None) if kind == "start" else (None,) * 4)
            )
        run, refused = brute_force_run(events)
        if run:
            expected[f"r{r}"] = (run["status"], run["stage"], run["failed"], run["done"], run["n"], run["at"], refused)
    frame = spark.createDataFrame(
        rows,
        "dag_id string, run_id string, seq bigint, at int, kind string, stage string, observations bigint, "
        "run_mode string, requested_start string, requested_end string, location_id bigint",
    )
    found = {
        r.run_id: (r.status, r.current_stage, r.failed_stage, r.finished_at, r.observations_loaded, r.started_at, r.refused_events)
        for r in run_audit.fold_runs(frame, width).collect()
    }
    assert found == expected
    assert run_audit.fold_runs(frame.limit(0)).collect() == []
    plan = run_audit.fold_runs(frame)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("SortAggregate", "Window", "Join"))


def test_page_audit(spark):
    def page(run, n, returned, found, limit="1000", stated=None, digest=None, ok=True):
        return ("m", run, n, ok, stated or str(n), limit, found, returned, digest or f"{run}-{n}")

    rows = [
        *(page("good", n, r, "2500") for n, r in ((1, 1000), (2, 1000), (3, 500))),
        *(page("beyond", n, 1000, "2000") for n in (1, 2, 3)),
        *(page("unknown", n, r, ">1000") for n, r in ((1, 1000), (2, 10))),
        *(page("open", n, 1000, "9000") for n in (1, 2)),
        page("repeat", 1, 1000, "3000", digest="x"),
        page("repeat", 2, 1000, "3000", digest="x"),
        page("total", 1, 1000, "3000"),
        page("total", 2, 1000, "3001"),
        page("limit", 1, 500, "3000", limit="500"),
        page("limit", 2, 500, "3000", limit="1000"),
        page("empty", 1, 1000, "3000"),
        page("empty", 2, 0, "3000"),
        page("number", 1, 1000, "3000", stated="2"),
        page("size", 1, 1001, "3000"),
        page("gap", 1, 1000, "3000"),
        page("gap", 3, 1000, "3000"),
    ]
    frame = spark.createDataFrame(
        rows,
        "resource string, run_id string, page bigint, results_ok boolean, meta_page string, meta_limit string, "
        "meta_found string, returned bigint, content_hash string",
    )
    found = {r.run_id: (r.status, r.pages_fetched, r.returned) for r in acquisition.audit_pages(frame).collect()}
    assert found == {
        "good": ("complete", 3, 2500),
        "beyond": ("complete", 2, 2000),
        "unknown": ("complete", 2, 1010),
        "open": ("incomplete", 2, 2000),
        "repeat": ("repeated_page", 2, 2000),
        "total": ("changed_total", 2, 2000),
        "limit": ("changed_page_size", 2, 1000),
        "empty": ("inconsistent_total", 2, 1000),
        "number": ("inconsistent_page_number", 1, 1000),
        "size": ("inconsistent_page_size", 1, 1001),
        "gap": ("inconsistent_page_number", 3, 2000),
    }


BATCH_DDL = (
    "location_id bigint, location_name string, sensor_id bigint, parameter string, datetime_from string, "
    "datetime_to string, returned bigint, found string, incomplete boolean, pagination_complete boolean, "
    "source_meta string, measurements string"
)


def batch(spark, measurements='[{"a":1}]', returned=1, **changes):
    row = dict(
        location_id=1, location_name=None, sensor_id=2, parameter="pm25", datetime_from="2026-09-01",
        datetime_to="2026-09-02", returned=returned, found="1", incomplete=False, pagination_complete=True,
        source_meta=None, measurements=measurements,
    )
    return spark.createDataFrame([tuple((row | changes).values())], BATCH_DDL)


def test_registry(spark, tmp_path):
    place = str(tmp_path / "registry")
    assert persist_run(spark, batch(spark), place, "r1")["batches_written"] == 1
    again = persist_run(spark, batch(spark, measurements='[{"a": 1.0}]'), place, "r2")
    assert (again["batches_written"], again["batches_reused"]) == (0, 1)
    with pytest.raises(ConflictError, match="20260901__20260902"):
        persist_run(spark, batch(spark, measurements='[{"a":2}]'), place, "r3")
    with pytest.raises(InputError, match="unsafe"):
        persist_run(spark, batch(spark), place, "r4", checkpoint_safe=False)
    with pytest.raises(InputError, match="returned"):
        persist_run(spark, batch(spark, returned=2), place, "r5")
    offset = batch(spark, datetime_from="2026-09-01T02:00:00+02:00", datetime_to="2026-09-02T00:00:00.5Z")
    persist_run(spark, offset, place, "r6")
    paths = {r.path.rsplit("/", 1)[1] for r in read_registry(spark, place).collect()}
    assert paths == {"20260901__20260902.json", "20260901T000000Z__20260902T000000.500000Z.json"}


def test_registry_under_two_writers(spark, tmp_path, monkeypatch):
    """Another run commits while this one has compared itself but not committed."""
    place = str(tmp_path / "registry")
    claim, turns = registry._claim, []

    def late(content):
        def run(*args):
            if not turns:
                turns.append(args[2])
                persist_run(spark, batch(spark, measurements=content).unionByName(batch(spark, content, sensor_id=3)), place, "other")
            return claim(*args)

        return run

    monkeypatch.setattr(registry, "_claim", late('[{"a":1.0}]'))
    own = batch(spark).unionByName(batch(spark, sensor_id=4))
    # The path that both bring is registered once; this run reuses it.
    assert persist_run(spark, own, place, "own") == {"batches_written": 1, "batches_reused": 1, "measurements_represented": 2}
    rows = [(r.path.split("/")[-2], r.run_id) for r in read_registry(spark, place).collect()]
    assert sorted(rows) == [("sensor_id=2", "other"), ("sensor_id=3", "other"), ("sensor_id=4", "own")]
    turns.clear()
    place = str(tmp_path / "clash")
    monkeypatch.setattr(registry, "_claim", late('[{"a":5}]'))
    with pytest.raises(ConflictError):
        persist_run(spark, own, place, "own")
    assert {r.run_id for r in read_registry(spark, place).collect()} == {"other"}


def test_arguments():
    for bad in ("o3", "PM25", ""):
        with pytest.raises(QueryArgumentError):
            serving.check_parameter(bad)
    for bad in (0, -1, True, "7", 2**63):
        with pytest.raises(QueryArgumentError):
            serving.check_location(bad)
    for bad in ("2026-9-1", "20260901", "2026-02-30"):
        with pytest.raises(QueryArgumentError):
            serving.check_date(bad)
    for bad in (0, 2001, True):
        with pytest.raises(QueryArgumentError):
            serving.check_limit(bad)


def test_display(spark):
    frame = spark.sql("SELECT timestamp'2026-09-29 23:53:00Z' t, date'2026-09-15' d, cast(null as timestamp) n")
    row = frame.select(
        instants.display_instant(F.col("t")), instants.display_bucket(F.col("d")),
        instants.display_short_date(F.col("d")), instants.display_instant(F.col("n")),
    ).first()
    assert tuple(row) == ("30 Sept 2026, 01:53 SAST", "15 Sept 2026, 02:00 SAST", "15 Sept", "Not available")
    numbers = spark.createDataFrame([(None,), (0.0,), (1234.56,), (-2.25,)], "v double")
    shown = [r[0] for r in numbers.select(serving.number_label(F.col("v"))).collect()]
    assert shown == ["—", "0", "1\xa0234,6", "-2,3"]


def test_text(spark):
    frame = spark.createDataFrame([("  PM2.5\t",), (" 　",)], "s string")
    rows = frame.select(text.strip(F.col("s")), text.is_blank(F.col("s")), text.compact(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("PM2.5", False, "PM25"), ("", True, "")]


def test_mentioned_locations_equal_brute_force(spark):
    names = [
        (1, "Table View"), (2, "Table"), (3, "Straße"), (4, "X"), (5, None), (6, ""), (7, "Table View"),
        (8, "Ofﬁce Aﬄuent"), (9, "ΟΔΥΣΣΕΥΣ"), (10, "ẞtadt"), (11, "İzmir"), (12, "ŉandi"), (13, "Ꭰ ſtation"),
    ]
    questions = [
        (1, "trend at table view please"), (2, "STRASSE?"), (3, "nothing"), (4, "the stable view"),
        (5, "max at X"), (6, ""), (7, "tableview"), (8, "office affluent"), (9, "οδυσσευς now"), (10, "οδυσσευσ"),
        (11, "SSTADT and straße"), (12, "i̇zmir"), (13, "izmir"), (14, "ʼnandi"), (15, "Ꭰ Station"), (16, "ﬆraSSe"),
    ]
    places = spark.createDataFrame(names, "location_id bigint, location_name string")
    asked = spark.createDataFrame(questions, "question_id bigint, text string")
    fold = str.casefold
    expected = {}
    for q, words in questions:
        hits = sorted((n, i) for i, n in names if n and fold(n) in fold(words))
        if hits:
            expected[q] = hits[0][1]
    found = {r.question_id: r.location_id for r in routing.mentioned_locations(asked, places).collect()}
    assert found == expected


def test_case_folding_equals_full_folding(spark):
    points = [chr(p) for p in range(0x250, 0x11000, 7) if not 0xD800 <= p < 0xE000] + [chr(p) for p in range(0x250)]
    words = [f"A{one}B ß" for one in points] + ["ﬀ ﬁ ﬂ ﬃ ﬄ ﬅ ﬆ", "ΣΑΣ ς", "ǰ ΐ ΰ ᾳ ῃ ῳ", "𐐀𐐨", ""]
    frame = spark.createDataFrame([(w,) for w in words], "s string").select("s", text.casefolded(F.col("s")).alias("folded"))
    wrong = [(r.s, r.folded) for r in frame.collect() if r.folded != r.s.casefold()]
    assert not wrong


def test_coordinate_rules(spark):
    rows = [
        (1, -26.0, 28.0), (1, -26.000005, 28.0), (1, None, 28.0),
        (2, -26.0, 28.0), (2, -26.1, 28.0),
        (3, None, 28.0), (3, -20.0, None),
        (4, 95.0, 10.0), (5, None, None),
    ]
    observed = spark.createDataFrame(rows, "location_id bigint, latitude double, longitude double")
    configured = spark.createDataFrame([(3, -33.0, 18.0)], "id bigint, latitude double, longitude double")
    found = {
        r.location_id: (r.latitude, r.longitude, r.coordinate_error)
        for r in geography.resolve_coordinates(observed, configured).collect()
    }
    assert found == {
        1: (-26.000005, 28.0, None),
        2: (None, None, "conflicting coordinates"),
        3: (-33.0, 18.0, None),
        4: (None, None, "coordinates out of bounds"),
        5: (None, None, "no confirmed coordinates"),
    }


def test_envelopes_carry_their_pages(spark):
    from envlake.sinks.registry import PAGINATION_DDL, prepare_batches
    from envlake.sources import envelopes

    columns = (
        "location_id bigint, location_name string, sensor_id bigint, parameter string, datetime_from string, datetime_to string,"
        " returned bigint, found bigint, incomplete boolean, pagination_complete boolean, source_meta string, measurements string,"
        f" pagination {PAGINATION_DDL}"
    )
    paging = (2, 1000, '">1000"', [(1, '{"found":">1000","page":1}', 1), (2, None, 0)])
    common = (101, "Site", 7, "pm25", "2025-04-10", "2025-04-11", 1, 1, False, True, None, "[1]")
    rows = [(*common, paging), (102, *common[1:], None)]
    found = {r.path: r.content for r in prepare_batches(spark.createDataFrame(rows, columns)).collect()}
    with_pages, without = (json.loads(found[path]) for path in sorted(found))
    assert with_pages["retrieval"]["pages_fetched"] == 2 and with_pages["retrieval"]["requested_page_size"] == 1000
    assert with_pages["retrieval"]["found"] == ">1000"
    assert with_pages["source_pages"] == [
        {"page": 1, "meta": {"found": ">1000", "page": 1}, "returned": 1},
        {"page": 2, "meta": None, "returned": 0},
    ]
    assert "source_pages" not in without and "pages_fetched" not in without["retrieval"] and without["retrieval"]["found"] == 1
    files = spark.createDataFrame(list(found.items()), "path string, content string")
    assert envelopes.parse_envelopes(files).filter("envelope_error IS NOT NULL").count() == 0
