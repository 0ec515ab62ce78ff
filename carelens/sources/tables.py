"""The sixteen clinical tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Tables, columns and types of the clinical record.
SCHEMAS: dict[str, str] = {
    "patient": "patient_id long, voided int",
    "patient_identifier": "patient_id long, identifier string, identifier_type int, "
                          "uuid string, voided int",
    "global_property": "property string, property_value string",
    "nigeria_datimcode_mapping": "datim_code string, state_name string, lga_name string",
    "obs": "obs_id long, person_id long, concept_id int, encounter_id long, "
           "obs_group_id long, obs_datetime timestamp_ntz, value_numeric double, "
           "value_coded int, value_datetime timestamp_ntz, value_text string, voided int",
    "concept_name": "concept_id int, name string, locale string, locale_preferred int",
    "encounter": "encounter_id long, patient_id long, form_id int, encounter_type int, "
                 "encounter_datetime timestamp_ntz, date_created timestamp_ntz, "
                 "creator long, voided int",
    "person": "person_id long, gender string, birthdate date, dead int, "
              "death_date timestamp_ntz, voided int",
    "person_name": "person_id long, given_name string, family_name string, voided int",
    "person_attribute": "person_id long, person_attribute_type_id int, value string, voided int",
    "person_attribute_type": "person_attribute_type_id int, name string",
    "person_address": "person_id long, address1 string",
    "patient_program": "patient_id long, program_id int, date_enrolled timestamp_ntz, voided int",
    "biometricinfo": "patient_Id long, date_created timestamp_ntz, template string, "
                     "new_template binary",
    "biometricverificationinfo": "patient_Id long, date_created timestamp_ntz, "
                                 "recapture_count int, fingerPosition string, imageQuality int",
    "users": "user_id long, person_id long",
}
# The large tables and the id a parallel database read is split on.
SPLIT_ON = {
    "patient": "patient_id",
    "person_address": "person_id",
    "patient_program": "patient_id",
    "users": "user_id",
    "obs": "obs_id",
    "encounter": "encounter_id",
    "patient_identifier": "patient_id",
    "person": "person_id",
    "person_name": "person_id",
    "person_attribute": "person_id",
    "biometricinfo": "patient_Id",
    "biometricverificationinfo": "patient_Id",
}


def load_clinical(spark: SparkSession, src: str | Mapping[str, str], *,
                  site: str | None = None,
                  bounds: Mapping[str, tuple[int, int]] | None = None,
                  num_partitions: int = 64,
                  one_partition: bool = False) -> dict[str, DataFrame]:
    """The clinical tables from a folder of Parquet tables or from a database.

    ``src`` is the folder, or the connection options of a database reader
    (``url``, ``user``, ...).  ``bounds`` gives the lowest and highest id of the large
    tables, so that their read is split into ``num_partitions`` ranges; a large table
    without them is an error, unless ``one_partition`` says that one task may read it.  ``site``
    names a facility column that all tables carry when several facilities share them.
    """
    extra = f"{site} string, " if site else ""
    if isinstance(src, str):
        return {t: spark.read.schema(extra + schema).parquet(f"{src}/{t}")
                for t, schema in SCHEMAS.items()}
    unbounded = sorted(SPLIT_ON.keys() & SCHEMAS.keys() - (bounds or {}).keys())
    if unbounded and not one_partition:
        raise ValueError(f"give bounds of the ids of {', '.join(unbounded)}, or one_partition=True")
    tables = {}
    for table, schema in SCHEMAS.items():
        reader = spark.read.format("jdbc").options(**src).option("dbtable", table)
        reader = reader.option("preferTimestampNTZ", "true")
        if bounds and table in bounds and table in SPLIT_ON:
            low, high = bounds[table]
            reader = reader.options(partitionColumn=SPLIT_ON[table], lowerBound=low,
                                    upperBound=high, numPartitions=num_partitions)
        fields = [f.strip().split(" ") for f in (extra + schema).split(",")]
        tables[table] = reader.load().selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])
    return tables
