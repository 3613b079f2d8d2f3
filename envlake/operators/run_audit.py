"""Run audit: events folded to one row per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import COUNT_KEEPING_STAGE, FAILURE_SUMMARY, FIRST_STAGE, RUN_STAGES
from envlake.functions import instants
from envlake.functions.rules import failed

RUN = ("dag_id", "run_id")

# Kinds of events and modes of runs.
KINDS = ("start", "stage", "count", "succeed", "fail")
MODES = ("historical", "incremental")


def with_window(events: DataFrame) -> DataFrame:
    """Requested window of start events as instants; other events have none.

    A date is midnight UTC; any other text must name its zone.
    """

    def boundary(value: Column) -> Column:
        day = instants.parse_date(value).cast("timestamp")
        historical = F.col("run_mode") == "historical"
        read = F.when(historical & day.isNotNull(), day).otherwise(instants.parse_instant(value))
        return F.when(F.col("kind") == "start", read)

    return events.withColumns(
        {name: boundary(F.col(name)) for name in ("requested_start", "requested_end")}
    )


def event_error() -> Column:
    """Reason why an event lies outside its domain, or null."""
    kind, stage = F.col("kind"), F.col("stage")
    known_stage = stage.isin(*RUN_STAGES)
    starts = kind == "start"
    return (
        F.when(failed(kind.isin(*KINDS)), "unknown kind")
        .when((kind == "stage") & failed(known_stage), "unknown stage")
        .when((kind == "fail") & stage.isNotNull() & failed(known_stage), "unknown stage")
        .when((kind == "count") & failed(F.col("observations") >= 0), "bad count")
        .when(starts & failed(F.col("run_mode").isin(*MODES)), "unknown run mode")
        .when(starts & failed(F.col("requested_end") > F.col("requested_start")), "bad window")
        .when(
            starts & F.col("location_id").isNotNull() & failed(F.col("location_id") > 0),
            "bad location",
        )
    )


def newest_run_events(events: DataFrame, dag_id: str) -> DataFrame:
    """Events of the run of a pipeline that was created last; the others need no folding."""
    own = events.filter(F.col("dag_id") == dag_id)
    starts = with_window(own.filter(F.col("kind") == "start")).filter(event_error().isNull())
    created = starts.groupBy("run_id").agg(F.min_by("at", "seq").alias("started_at"))
    newest = created.orderBy(F.desc_nulls_first("started_at"), F.desc("run_id")).limit(1)
    return own.join(newest.select("run_id"), "run_id", "left_semi")


# What a run can be when an event meets it: not started, running, or ended either way.
NOT_STARTED, RUNNING, SUCCEEDED, FAILED = range(4)

SET_FIELDS = ("stage", "end_at", "failed_stage", "loaded")


def _state_type(at: str) -> str:
    """State of a run, or what a piece of its log does to one: a null wrapper says that nothing was set."""
    return (
        "struct<phase: int, created: struct<run_mode: string, requested_start: timestamp, requested_end: timestamp,"
        f" location_id: bigint, at: {at}>, stage: struct<v: string>, end_at: struct<v: {at}>,"
        " failed_stage: struct<v: string>, loaded: struct<v: bigint>, refused: bigint>"
    )


def _entry_state(phase: int, at: str) -> Column:
    """A run in a phase, with nothing set; ``at`` is the type of event times."""
    nothing = [F.lit(None).alias(name) for name in ("created", *SET_FIELDS)]
    return F.struct(F.lit(phase).alias("phase"), *nothing, F.lit(0).alias("refused")).cast(_state_type(at))


def _after_event(state: Column, event: Column, at_type: str) -> Column:
    """The state that one event leaves."""
    kind, phase = event["kind"], state["phase"]

    def holding(value: Column) -> Column:
        return F.struct(value.alias("v"))

    def changed(**fields: Column) -> Column:
        return F.struct(*(fields.get(name, state[name]).alias(name) for name in ("phase", "created", *SET_FIELDS, "refused")))

    types = {"end_at": at_type, "failed_stage": "string", "loaded": "bigint"}
    unset = {name: holding(F.lit(None).cast(type_name)) for name, type_name in types.items()}
    created = F.struct(*(event[name].alias(name) for name in ("run_mode", "requested_start", "requested_end", "location_id", "at")))
    kept = F.when(event["stage"] == COUNT_KEEPING_STAGE, state["loaded"]).otherwise(unset["loaded"])
    refused = changed(refused=state["refused"] + 1)
    at, stage = holding(event["at"]), holding(event["stage"])
    return (
        F.when(kind == "start", F.when(phase == NOT_STARTED, changed(phase=F.lit(RUNNING), created=created)).otherwise(state))
        .when(phase == NOT_STARTED, refused)
        .when(kind == "stage", changed(**{**unset, "phase": F.lit(RUNNING), "stage": stage, "loaded": kept}))
        .when((kind == "count") & (phase == RUNNING), changed(loaded=holding(event["observations"])))
        .when((kind == "succeed") & (phase == RUNNING), changed(phase=F.lit(SUCCEEDED), end_at=at))
        .when((kind == "fail") & (phase == RUNNING), changed(phase=F.lit(FAILED), end_at=at, failed_stage=stage))
        .when((kind == "succeed") & (phase == SUCCEEDED), state)
        # The first failure ended the run; another one names its stage anew.
        .when((kind == "fail") & (phase == FAILED), changed(failed_stage=stage))
        .otherwise(refused)
    )


def _after_block(state: Column, effects: Column) -> Column:
    """The state that a block leaves: of its effects by phase, those for the phase the run is in."""
    effect = F.element_at(effects, state["phase"] + 1)
    return F.struct(
        effect["phase"].alias("phase"),
        F.coalesce(state["created"], effect["created"]).alias("created"),
        *(F.coalesce(effect[name], state[name]).alias(name) for name in SET_FIELDS),
        (state["refused"] + effect["refused"]).alias("refused"),
    )


def fold_runs(events: DataFrame, width: int = 100_000) -> DataFrame:
    """Final state of every run that was started.

    events: dag_id, run_id, seq (unique per run), at, kind, stage, observations,
    run_mode, requested_start, requested_end (text), location_id.

    * The first start creates the run, further starts change nothing, and any
      event before it has no run to act on.
    * A stage event sets the run running again; the loaded count survives only
      into the count-keeping stage.
    * A count needs a running run. The first success or failure after a stage
      decides; the opposite one is refused until the next stage.

    A log is cut into blocks of at most ``width`` events by sequence number. A block is
    folded without its predecessors: for each phase that the run may be in before it, into
    the phase afterwards and the fields it sets. Such effects compose, so a second
    aggregation over one row per block gives the run. Events are read and shuffled once,
    and no task holds more of a run than a block or its blocks' effects.
    """
    valid = with_window(events).filter(event_error().isNull())
    at_type = events.schema["at"].dataType.simpleString()
    event = F.struct(
        F.col("seq").cast("bigint").alias("seq"),
        "kind",
        "stage",
        "at",
        F.col("observations").cast("bigint").alias("observations"),
        "run_mode",
        "requested_start",
        "requested_end",
        F.col("location_id").cast("bigint").alias("location_id"),
    )
    entries = F.array(*(_entry_state(phase, at_type) for phase in (NOT_STARTED, RUNNING, SUCCEEDED, FAILED)))
    blocks = (
        valid.groupBy(*RUN, F.floor(F.col("seq") / width).cast("bigint").alias("block"))
        .agg(F.sort_array(F.collect_list(event)).alias("events"))
        .select(
            *RUN,
            "block",
            F.aggregate(
                "events", entries, lambda states, e: F.transform(states, lambda state: _after_event(state, e, at_type))
            ).alias("effects"),
        )
    )
    runs = (
        blocks.groupBy(*RUN)
        .agg(F.sort_array(F.collect_list(F.struct("block", "effects"))).alias("blocks"))
        .select(
            *RUN,
            F.aggregate(
                "blocks", _entry_state(NOT_STARTED, at_type), lambda state, block: _after_block(state, block["effects"])
            ).alias("final"),
        )
        .filter("final.created IS NOT NULL")
    )
    stage = F.coalesce("final.stage.v", F.lit(FIRST_STAGE))
    phase = F.col("final.phase")
    has_failed = phase == FAILED
    return runs.select(
        *RUN,
        "final.created.run_mode",
        "final.created.requested_start",
        "final.created.requested_end",
        "final.created.location_id",
        F.when(phase == SUCCEEDED, "succeeded").when(has_failed, "failed").otherwise("running").alias("status"),
        stage.alias("current_stage"),
        F.when(has_failed, F.coalesce("final.failed_stage.v", stage)).alias("failed_stage"),
        F.col("final.created.at").alias("started_at"),
        F.col("final.end_at.v").alias("finished_at"),
        F.col("final.loaded.v").alias("observations_loaded"),
        F.when(has_failed, FAILURE_SUMMARY).alias("error_summary"),
        F.col("final.refused").alias("refused_events"),
    )
