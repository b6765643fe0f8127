"""Review rules as Columns: the reason text, or NULL where the rule holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reason_if(condition: Column, reason: str) -> Column:
    return F.when(condition, F.lit(reason))


def first_reason(*reasons: Column) -> Column:
    """The first rule that fails."""
    return F.coalesce(*reasons)


def event_date_reason(event: Column, birth: Column, field: str, as_of: Column) -> Column:
    return first_reason(
        reason_if(event.isNull(), f"{field} must not be null."),
        reason_if(event < birth, f"{field} occurs before birth date."),
        reason_if(event > as_of, f"{field} is in the future."),
    )


def concept_reason(concept_id: Column, domain: Column, expected: str, label: str) -> Column:
    return first_reason(
        reason_if(concept_id == 0, f"{label} could not be mapped to a standard {expected} concept."),
        reason_if((domain != "") & (domain != expected), f"{label} mapped to the wrong OMOP domain for {expected}."),
    )


def is_measurement(domain: Column, kind: Column) -> Column:
    """Whether an observation row is a measurement: true, false or NULL.

    NULL is an answer of its own: such a row belongs to neither table.
    """
    known = F.nullif(domain, F.lit(""))
    return (known == "Measurement") | (known.isNull() & (kind == "NUMERIC"))

