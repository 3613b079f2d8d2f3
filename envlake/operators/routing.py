"""Routing of questions to the data they need, and conversation bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from envlake.domain import PARAMETERS
from envlake.functions import text

# Terms per intent and conversation bounds. ---------------------

SUMMARY_TERMS = (
    "how many",
    "average",
    "observations",
    "weather coverage",
    "recent",
    "latest",
    "how old",
    "air-quality data",
    "air quality data",
)
LOCATION_TERMS = ("station", "stations", "location", "locations")
COMPARISON_TERMS = ("highest", "lowest", "compare", "comparison", "which station")
HEALTH_TERMS = ("pipeline", "refresh", "orchestration", "data health")
TREND_TERMS = ("trend", "daily", "over time", "history", "historical pattern")
WEATHER_TERMS = ("temperature", "humidity", "wind", "rain", "precipitation")

QUESTION_LIMIT = 1200
MESSAGE_LIMIT = 600
HISTORY_MESSAGES = 6
HISTORY_LIMIT = 3000
ROLES = ("user", "assistant")

SERIES_LIMIT = 120

# End of fixed values. --------------------------------------------------------

INTENTS = {
    "needs_summary": SUMMARY_TERMS,
    "needs_locations": LOCATION_TERMS,
    "needs_comparison": COMPARISON_TERMS,
    "needs_health": HEALTH_TERMS,
    "needs_trends": TREND_TERMS,
    "needs_weather": WEATHER_TERMS,
}

# Characters that anchor a location name inside a question.
ANCHOR = 4


def mentions(question: Column, terms: tuple[str, ...]) -> Column:
    """True when any term occurs anywhere in the folded question."""
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(question, F.lit(term))
    return found


def question_intents(questions: DataFrame) -> DataFrame:
    """Intent flags and mentioned parameters per question (question_id, text)."""
    asked = questions.withColumn("_q", text.casefolded(F.col("text")))
    squeezed = text.compact(F.col("_q"))
    named = F.array(*(F.when(F.contains(squeezed, F.lit(p)), F.lit(p)) for p in PARAMETERS))
    return asked.select(
        *questions.columns,
        *(mentions(F.col("_q"), terms).alias(name) for name, terms in INTENTS.items()),
        F.array_compact(named).alias("parameters"),
    )


def mentioned_locations(questions: DataFrame, locations: DataFrame) -> DataFrame:
    """The first location, by name and id, whose name occurs in the question.

    Substring containment as two equi-joins instead of a pairwise test: question
    positions whose next characters open some name survive a lookup by hash, then
    substrings of the lengths seen for that opening are matched with whole names.
    Positions travel as numbers; the text joins those that survive. Work per question
    grows with its length, not with the number of locations.
    """
    names = (
        locations.filter(F.col("location_name") != "")
        .select("location_id", "location_name", text.casefolded(F.col("location_name")).alias("needle"))
        .withColumn("anchor", F.substring("needle", 1, ANCHOR))
        .withColumn("length", F.length("needle"))
    )
    # Equal names answer alike: keep the one that comes first.
    first_named = names.groupBy("needle").agg(
        F.min(F.struct("location_name", "location_id")).alias("place")
    )
    # Distinct lengths of names with one opening; short names are their own opening.
    openings = names.select(F.xxhash64("anchor").alias("opening"), "length").distinct()
    # Only openings as long as some name has are looked up (at most ANCHOR sizes).
    sizes = names.agg(F.collect_set(F.length("anchor")).alias("n")).scalar()
    asked = questions.select("question_id", text.casefolded(F.col("text")).alias("_q")).filter("_q <> ''")
    starts = asked.select(
        "question_id", "_q", sizes.alias("sizes"), F.explode(F.sequence(F.lit(1), F.length("_q"))).alias("at")
    )
    pieces = starts.select("question_id", "_q", "at", F.explode("sizes").alias("size")).select(
        "question_id", "at", F.xxhash64(F.substring("_q", F.col("at"), F.col("size"))).alias("opening")
    )
    candidates = pieces.join(openings, "opening").select("question_id", "at", "length").distinct()
    needles = (
        candidates.join(asked, "question_id")
        .select("question_id", F.substring("_q", F.col("at"), F.col("length")).alias("needle"))
        .distinct()
    )
    matched = needles.join(first_named, "needle")
    return (
        matched.groupBy("question_id")
        .agg(F.min("place").alias("place"))
        .select("question_id", "place.location_id", "place.location_name")
    )


def question_plan(questions: DataFrame, locations: DataFrame) -> DataFrame:
    """What each question needs, decided from its intents.

    Health answers carry the summary and suppress it on its own. A series needs
    a trend or weather intent, a parameter and a named location; weather wins.
    """
    intents = question_intents(questions)
    series_intent = F.col("needs_trends") | F.col("needs_weather")
    found = mentioned_locations(questions, locations)
    joined = intents.join(found, "question_id", "left")
    wants_series = (
        series_intent & (F.size("parameters") > 0) & F.col("location_id").isNotNull()
    )
    both = F.array(*map(F.lit, PARAMETERS))
    none = F.array().cast("array<string>")
    compared = F.when(F.size("parameters") > 0, F.col("parameters")).otherwise(both)
    return joined.select(
        "question_id",
        F.col("needs_health").alias("uses_data_health"),
        (F.col("needs_summary") & ~F.col("needs_health")).alias("uses_summary"),
        ((F.col("needs_locations") & ~F.col("needs_comparison")) | series_intent).alias(
            "uses_catalogue"
        ),
        F.when(F.col("needs_comparison"), compared).otherwise(none).alias("compared_parameters"),
        F.when(wants_series, F.when(F.col("needs_weather"), "weather").otherwise("trends")).alias(
            "series_kind"
        ),
        F.when(wants_series, F.col("location_id")).alias("series_location_id"),
        F.when(wants_series, F.col("parameters")).otherwise(none).alias("series_parameters"),
    )


def station_catalogue(locations_with_parameters: DataFrame) -> DataFrame:
    return locations_with_parameters.select("location_id", "location_name", "parameters")


def conversation_bounds(messages: DataFrame) -> DataFrame:
    """Bounds per conversation (conv_id, turn, role, text).

    The last turn is the question, everything before it is history. Lengths are
    limited before stripping, the history total after stripping.
    """
    stripped = F.length(text.strip(F.col("text")))
    counted = messages.select(
        "conv_id",
        "turn",
        F.length("text").alias("raw"),
        F.coalesce(stripped, F.lit(0)).alias("net"),
        F.col("role").isin(*ROLES).alias("known_role"),
    )
    # A message breaks the message rule unless it turns out to be the question.
    too_long = F.coalesce((F.col("raw") > MESSAGE_LIMIT), F.lit(True))
    as_int = lambda flag: F.coalesce(flag, F.lit(False)).cast("int")
    unknown_role = ~F.coalesce(F.col("known_role"), F.lit(False))
    last = F.max_by(
        F.struct(
            "raw",
            "net",
            as_int(too_long).alias("long"),
            as_int(F.col("net") == 0).alias("blank"),
            as_int(unknown_role).alias("role"),
        ),
        "turn",
    )
    folded_rows = counted.groupBy("conv_id").agg(
        (F.count(F.lit(1)) - 1).alias("history_messages"),
        F.sum("net").alias("net"),
        F.sum(as_int(too_long)).alias("long"),
        F.sum(as_int(F.col("net") == 0)).alias("blank"),
        F.sum(as_int(unknown_role)).alias("role"),
        last.alias("question"),
    )
    history = {name: F.col(name) - F.col(f"question.{name}") for name in ("net", "long", "blank", "role")}
    checks = [
        ("question_blank", F.col("question.net") == 0),
        ("question_too_long", F.coalesce(F.col("question.raw") > QUESTION_LIMIT, F.lit(True))),
        ("too_many_messages", F.col("history_messages") > HISTORY_MESSAGES),
        ("message_blank", history["blank"] > 0),
        ("message_too_long", history["long"] > 0),
        ("unknown_role", history["role"] > 0),
        ("history_too_long", history["net"] > HISTORY_LIMIT),
    ]
    reasons = F.array(*(F.when(broken, F.lit(name)) for name, broken in checks))
    return folded_rows.select(
        "conv_id",
        "history_messages",
        history["net"].cast("bigint").alias("history_characters"),
        F.array_join(F.array_compact(reasons), ",").alias("violations"),
    )
