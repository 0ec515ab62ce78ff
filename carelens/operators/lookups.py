"""Enrichment joins.

Every right-hand side is first reduced to one row per key, so no join fans out.
No side is forced into a broadcast: Spark sends a side everywhere only while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.text import full_name, normalise_id
from carelens.operators.filters import live
from carelens.operators.keys import Keys, key_list, match, match_many

# Identifier types and the columns they become.
IDENTIFIER_TYPES = {
    "PatientHospitalNo": 5,
    "PatientUniqueID": 4,
    "ANCNoIdentifier": 6,
    "HTSNo": 8,
}


def pivot_identifiers(identifiers: DataFrame, types: Mapping[str, int], patient: Keys,
                      uuid_of: str | None = None, only_live: bool = True,
                      normalise_ids: bool = False) -> DataFrame:
    """One row per patient with a column per identifier type (smallest if several)."""
    rows = live(identifiers) if only_live else identifiers
    value = normalise_id("identifier") if normalise_ids else F.col("identifier")
    kind = F.col("identifier_type")
    columns = [F.min(F.when(kind == t, value)).alias(out) for out, t in types.items()]
    if uuid_of is not None:
        columns.append(F.min(F.when(kind == types[uuid_of], F.col("uuid"))).alias("uuid"))
    return rows.filter(kind.isin(*types.values())).groupBy(*key_list(patient)).agg(*columns)


def attach_identifiers(patients: DataFrame, identifiers: DataFrame,
                       types: Mapping[str, int] = IDENTIFIER_TYPES,
                       patient: Keys = "patient_id", uuid_of: str | None = None,
                       normalise_ids: bool = False) -> DataFrame:
    """Add one column per identifier type; soft-deleted patients get none."""
    found = pivot_identifiers(identifiers, types, patient, uuid_of,
                              normalise_ids=normalise_ids)
    owners = live(patients).select(*key_list(patient))
    return patients.join(found.join(owners, key_list(patient), "left_semi"),
                         key_list(patient), "left")


def attach_parameters(df: DataFrame, properties: DataFrame, wanted: Mapping[str, str],
                      site: Keys = (), name: str = "property",
                      value: str = "property_value") -> DataFrame:
    """Add settings held as (property, value) rows to every row.

    With one facility the settings are a scalar subquery; with several, the settings
    of a facility are one row, joined on the facility.
    """
    keys = key_list(site)
    rows = properties.filter(F.col(name).isin(*wanted.values())).groupBy(*keys).agg(*[
        F.max(F.when(F.col(name) == p, F.col(value))).alias(out) for out, p in wanted.items()])
    if keys:
        return match_many(df, rows, keys, keys)
    one = rows.select(F.struct(*wanted)).scalar()
    return df.withColumn("__settings", one).select("*", "__settings.*").drop("__settings")


def attach_facility(df: DataFrame, mapping: DataFrame, code: str = "DatimCode",
                    mapping_code: str = "datim_code",
                    columns: Mapping[str, str] | None = None) -> DataFrame:
    """Facility code to its region names, all from the smallest row of a repeated code."""
    columns = columns or {"State": "state_name", "LGA": "lga_name"}
    row = F.struct(*[F.col(source).alias(out) for out, source in columns.items()])
    one = mapping.groupBy(mapping_code).agg(F.min(row).alias("__row")).select(mapping_code, "__row.*")
    return match_many(df, one, code, mapping_code)


def attach_encounter(obs: DataFrame, encounters: DataFrame, columns: Sequence[str],
                     encounter: Keys = "encounter_id", voided: str = "voided") -> DataFrame:
    """Columns of the live encounter of each observation."""
    keys = key_list(encounter)
    return obs.join(live(encounters, voided).select(*keys, *columns), keys, "left")


def decode_coded(df: DataFrame, names: DataFrame, coded: str = "value_coded",
                 out: str = "name", site: Keys = ()) -> DataFrame:
    """Coded answer to its preferred name; ``names`` holds one row per concept."""
    keys = key_list(site)
    named = names.withColumnRenamed("name", out)
    return match_many(df, named, [*keys, coded], [*keys, "concept_id"])


def flag_exists(df: DataFrame, other: DataFrame, keys: Keys, other_keys: Keys, out: str,
                yes: str = "Yes", no: str = "No") -> DataFrame:
    """Whether the key occurs in another table."""
    present = other.select(*key_list(other_keys)).distinct().withColumn("__hit", F.lit(True))
    flagged = match_many(df, present, keys, other_keys)
    return flagged.withColumn(
        out, F.when(F.col("__hit"), yes).otherwise(no)).drop("__hit")


def phone_numbers(attributes: DataFrame, attribute_types: DataFrame, person: Keys,
                  site: Keys = (), type_name: str = "Telephone Number") -> DataFrame:
    """Values of the attribute type that has a given name."""
    keys = key_list(site)
    wanted = attribute_types.filter(F.col("name") == type_name)
    if keys:
        rows = attributes.join(wanted.select(*keys, "person_attribute_type_id"),
                               [*keys, "person_attribute_type_id"], "left_semi")
    else:
        type_id = wanted.agg(F.min("person_attribute_type_id")).scalar()
        rows = attributes.filter(F.col("person_attribute_type_id") == type_id)
    return rows.groupBy(*key_list(person)).agg(F.min("value").alias("Phone_No"))


def person_names(names: DataFrame, person: Keys) -> DataFrame:
    """One full name per person: the smallest live one."""
    return live(names).groupBy(*key_list(person)).agg(
        F.min(full_name("given_name", "family_name")).alias("Patient_Name"))


def attach_demographics(df: DataFrame, persons: DataFrame, names: DataFrame,
                        attributes: DataFrame, attribute_types: DataFrame,
                        addresses: DataFrame, person: Keys = "person_id",
                        site: Keys = ()) -> DataFrame:
    """Sex, date of birth, name, phone and address, one row per person each."""
    keys = key_list(person)
    basics = persons.groupBy(*keys).agg(
        F.min("gender").alias("Sex"), F.min("birthdate").alias("DOB"))
    homes = addresses.groupBy(*keys).agg(F.min("address1").alias("Patient_Address"))
    phones = phone_numbers(attributes, attribute_types, keys, site)
    for side in (basics, person_names(names, keys), phones, homes):
        df = df.join(side, keys, "left")
    return df


def attach_entered_by(encounters: DataFrame, users: DataFrame, names: DataFrame,
                      creator: str = "creator", site: Keys = ()) -> DataFrame:
    """Name of the user who created a record: creator, user, person name."""
    keys = key_list(site)
    who = users.groupBy(*keys, "user_id").agg(F.min("person_id").alias("person_id"))
    full = person_names(names, [*keys, "person_id"]).withColumnRenamed("Patient_Name", "EnteredBy")
    staff = who.join(full, [*keys, "person_id"], "left").drop("person_id")
    return match_many(encounters, staff, [*keys, creator], [*keys, "user_id"])


def lookup_unique(df: DataFrame, other: DataFrame, key: Keys, columns: Sequence[str],
                  null_safe: bool = True) -> DataFrame:
    """Bring columns over by a unique key; a repeated key fails the query.

    A missing key matches the row whose key is missing.  All columns come with one
    join, and the check is part of the same plan.
    """
    keys = key_list(key)
    packed = F.struct(*[F.col(f"`{c}`") for c in columns])
    counted = other.groupBy(*keys).agg(
        F.count("*").alias("__n"), F.any_value(packed).alias("__row"))
    checked = counted.select(*keys, F.when(
        F.col("__n") > 1, F.raise_error(F.lit("lookup key is not unique")).cast(
            counted.schema["__row"].dataType)).otherwise(F.col("__row")).alias("__row"))
    found = match(df, checked, keys, keys, null_safe=null_safe)
    return found.select(*[F.col(f"`{c}`") for c in df.columns],
                        *[F.col("__row")[c].alias(c) for c in columns])


def lookup_baseline(df: DataFrame, base: DataFrame, columns: Sequence[str],
                    key: str = "key", suffix: str = "_baseline") -> DataFrame:
    """Bring the columns of an earlier report over by its composite text key."""
    other = base.select(key, *[F.col(f"`{c}`").alias(f"{c}{suffix}") for c in columns])
    return df.join(other, key, "left")
