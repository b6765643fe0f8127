"""Locations, persons, deaths, care sites and providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions.codes import ethnicity_concept, gender_concept, race_concept
from clinloom.functions.rules import event_date_reason
from clinloom.functions.text import clipped, cut, row_id, safe_double
from clinloom.operators.ids import Numbered
from clinloom.operators.lookups import lookup_side


def _address(kind: str, location_id: Column, county: Column) -> list[Column]:
    return [
        location_id.cast("long").alias("location_id"),
        clipped("ADDRESS", 50).alias("address_1"),
        clipped("CITY", 50).alias("city"),
        clipped("STATE", 2).alias("state"),
        clipped("ZIP", 9).alias("zip"),
        county.cast("string").alias("county"),
        cut(F.concat(F.lit(kind + ":"), F.col("Id")), 50).alias("location_source_value"),
        F.lit("US").alias("country_source_value"),
        safe_double("LAT").alias("latitude"),
        safe_double("LON").alias("longitude"),
    ]


def patient_location_id(organizations: Numbered) -> Column:
    """Locations are numbered organizations first, then patients, both by Id.

    Person and care-site ids run in the same orders, so the location id follows
    from them without a join.
    """
    return F.col("person_id") + organizations.rows


def location(patients: Numbered, organizations: Numbered) -> DataFrame:
    of_organizations = organizations.df.select(*_address("ORGANIZATION", F.col("care_site_id"), F.lit(None)))
    of_patients = patients.df.select(*_address("PATIENT", patient_location_id(organizations), clipped("COUNTY", 20)))
    return of_organizations.unionByName(of_patients)


def person(patients: Numbered, organizations: Numbered) -> DataFrame:
    gender, race, ethnicity = gender_concept("GENDER"), race_concept("RACE"), ethnicity_concept("ETHNICITY")
    born = F.col("BIRTHDATE")
    return patients.df.select(
        "person_id",
        gender.alias("gender_concept_id"),
        F.coalesce(F.year(born), F.lit(1900)).alias("year_of_birth"),
        F.month(born).alias("month_of_birth"),
        F.dayofmonth(born).alias("day_of_birth"),
        born.cast("timestamp_ntz").alias("birth_datetime"),
        race.alias("race_concept_id"),
        ethnicity.alias("ethnicity_concept_id"),
        F.when(F.col("Id").isNotNull(), patient_location_id(organizations)).alias("location_id"),
        cut("Id", 50).alias("person_source_value"),
        clipped("GENDER", 50).alias("gender_source_value"),
        gender.alias("gender_source_concept_id"),
        clipped("RACE", 50).alias("race_source_value"),
        race.alias("race_source_concept_id"),
        clipped("ETHNICITY", 50).alias("ethnicity_source_value"),
        ethnicity.alias("ethnicity_source_concept_id"),
    )


def death_stage(patients: Numbered, as_of: Column) -> DataFrame:
    died = F.col("DEATHDATE")
    return patients.df.where(died.isNotNull() & F.col("Id").isNotNull()).select(
        row_id("patients", "Id", F.lit("death")).alias("source_row_id"),
        "person_id",
        died.alias("death_date"),
        died.cast("timestamp_ntz").alias("death_datetime"),
        F.lit(S.DEATH_TYPE).alias("death_type_concept_id"),
        F.lit(S.NO_MATCH).alias("cause_concept_id"),
        event_date_reason(died, F.col("BIRTHDATE"), "death_date", as_of).alias("review_reason"),
    )


def care_site(organizations: Numbered) -> DataFrame:
    return organizations.df.select(
        "care_site_id",
        clipped("NAME", 255).alias("care_site_name"),
        F.when(F.col("Id").isNotNull(), F.col("care_site_id")).alias("location_id"),
        cut("Id", 50).alias("care_site_source_value"),
    )


def provider(providers: Numbered, organizations: Numbered) -> DataFrame:
    sites = lookup_side(
        organizations.df.select("care_site_id", F.col("Id").alias("ORGANIZATION")), organizations.rows
    )
    gender = gender_concept("GENDER")
    return providers.df.join(sites, "ORGANIZATION", "left").select(
        "provider_id",
        clipped("NAME", 255).alias("provider_name"),
        "care_site_id",
        gender.alias("gender_concept_id"),
        cut("Id", 50).alias("provider_source_value"),
        clipped("SPECIALITY", 50).alias("specialty_source_value"),
        clipped("GENDER", 50).alias("gender_source_value"),
        gender.alias("gender_source_concept_id"),
    )
