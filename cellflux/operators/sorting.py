"""Lines sorted into events and rejected lines by one parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellflux.config import Settings
from cellflux.functions import field_value
from cellflux.operators.clean import repair_measures, with_event_time
from cellflux.operators.lines import Arity
from cellflux.schema import EVENTS_SCHEMA, RECORD_FIELDS, RECORD_SCHEMA, SEPARATOR

EVENT, REJECTED = "event", "rejected"


def _reason(arity: Arity, settings: Settings) -> Column:
    """Why a line is no event; NULL for an event."""
    fields, cell = F.size("fields"), F.col("cell_id")
    text = F.get("fields", F.lit(0))
    reason = F.when(~F.col("line").rlike(r"[^\x00-\x20]"), "blank")
    if arity == "strict":
        reason = reason.when(fields < len(RECORD_FIELDS), "too few fields")
        reason = reason.when(fields > len(RECORD_FIELDS), "too many fields")
    reason = reason.when(F.btrim(text) == "", "cell missing").when(cell.isNull(), "cell is no number")
    in_range = cell.between(settings.min_cell, settings.max_cell)
    return reason.when(~in_range, "cell out of range")


def sorted_lines(lines: DataFrame, settings: Settings | None = None, arity: Arity = "strict") -> DataFrame:
    """A row per line, by `kind`: a cleaned event, or a rejected `line` with the `reason`.

    The events are those of `clean(decode_lines(lines))`. Every line has one row, a missing one too, so that kept
    and rejected lines add up to the lines read. Works on batch and streaming input; written by kind, both
    outputs come from one parse.
    """
    if arity not in ("strict", "pad"):
        raise ValueError(f"arity must be 'strict' or 'pad', not {arity!r}")
    settings = settings or Settings()
    line = F.coalesce(F.col("value").cast("string"), F.lit(""))
    fields = F.split(line, SEPARATOR, len(RECORD_FIELDS) + 1)
    # As rows of a one-element array, so that no later column splits the line again.
    once = F.explode(F.array(F.struct(line.alias("line"), fields.alias("fields"))))
    split = lines.select(once.alias("once")).select("once.*")
    record = [
        field_value(F.get("fields", F.lit(i)), field.dataType).alias(field.name)
        for i, field in enumerate(RECORD_SCHEMA)
    ]
    judged = split.select("line", "fields", *record).withColumn("reason", _reason(arity, settings))
    cleaned = with_event_time(repair_measures(judged), settings)
    event = F.col("reason").isNull()
    return cleaned.select(
        *[F.when(event, F.col(c)).alias(c) for c in [*RECORD_FIELDS, "event_time", "hour"]],
        F.when(~event, F.col("line")).alias("line"),
        "reason",
        F.when(event, EVENT).otherwise(REJECTED).alias("kind"),
        F.when(event, F.col("date")).alias("date"),
    )


def kept_events(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.filter(F.col("kind") == EVENT).select(EVENTS_SCHEMA.fieldNames())


def rejected_lines(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.filter(F.col("kind") == REJECTED).select("line", "reason")


def line_counts(sorted_rows: DataFrame, observation: Observation | str = "lines") -> DataFrame:
    """The same rows, counted as they pass: `read`, `kept`, `rejected`.

    An `Observation` tells them after a batch write; under a name they are in a stream's progress.
    """
    kept = F.col("kind") == EVENT
    return sorted_rows.observe(
        observation,
        F.count(F.lit(1)).alias("read"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("rejected"),
    )
