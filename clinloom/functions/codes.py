"""Fixed code lists to concept ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions.text import normalized


def _lookup(key: Column, mapping: dict[str, int], default: int) -> Column:
    chain = None
    for word, concept_id in mapping.items():
        chain = F.when(key == word, concept_id) if chain is None else chain.when(key == word, concept_id)
    return chain.otherwise(default).cast("int")


def gender_concept(value: Column | str) -> Column:
    return _lookup(F.upper(normalized(value)), S.GENDER, S.GENDER_UNKNOWN)


def race_concept(value: Column | str) -> Column:
    return _lookup(F.lower(normalized(value)), S.RACE, S.RACE_UNKNOWN)


def ethnicity_concept(value: Column | str) -> Column:
    return _lookup(F.lower(normalized(value)), S.ETHNICITY, S.NO_MATCH)


def visit_concept(value: Column | str) -> Column:
    return _lookup(F.lower(normalized(value)), S.VISIT_CLASS, S.NO_MATCH)
