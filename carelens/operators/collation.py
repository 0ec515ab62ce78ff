"""Texts compared as a database with a case-blind collation compares them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators.keys import Keys, key_list, match_many
from carelens.operators.lookups import IDENTIFIER_TYPES

#: Blind to case, accents and trailing blanks.
DATABASE_COLLATION = "UNICODE_CI_AI_RTRIM"


def one_spelling(df: DataFrame, text: str, collation: str = DATABASE_COLLATION,
                 among: Keys = ()) -> DataFrame:
    """``df`` with one spelling of ``text`` for all that the collation holds equal.

    It is the smallest by code point, within ``among`` (a facility, say), so what is grouped
    or joined later compares plain text.  Spellings merge on the map side before they are
    shuffled, and the join that brings the one back is split where one text is very frequent.
    A missing text stays missing; an empty one equals one of blanks if the collation ignores
    trailing blanks.
    """
    keys = key_list(among)
    spelled = df.select(*keys, text).distinct().filter(F.col(text).isNotNull())
    shared = F.collate(text, collation)
    classes = spelled.groupBy(*keys, shared.alias("__class")).agg(F.min(text).alias("__one"))
    own = spelled.withColumn("__class", shared).join(classes, [*keys, "__class"]).select(*keys, text, "__one")
    found = match_many(df, own, [*keys, text], [*keys, text])
    return found.withColumn(text, F.col("__one")).drop("__one")


def compared_as_stored(tables: Mapping[str, DataFrame], collation: str = DATABASE_COLLATION,
                       site: Keys = ()) -> dict[str, DataFrame]:
    """The clinical tables with hospital numbers and answer names as the collation compares them.

    Equal hospital numbers get one spelling, that of the smallest live one.  So do equal names of
    concepts, which moreover carry the collation, so that the largest of several names, and
    a name's comparison with a constant, follow it.  Names of persons, other identifiers and free
    text stay as they are.  ``plain_text`` takes the collation off the result.
    """
    s = key_list(site)
    identifiers = tables["patient_identifier"]
    is_number = F.col("identifier_type") == IDENTIFIER_TYPES["PatientHospitalNo"]
    counted = F.coalesce(is_number & (F.col("voided") == 0), F.lit(False))
    numbers = one_spelling(identifiers.filter(counted), "identifier", collation, s)
    names = one_spelling(tables["concept_name"], "name", collation, s)
    return {
        **tables,
        "patient_identifier": identifiers.filter(~counted).unionByName(numbers),
        "concept_name": names.withColumn("name", F.collate("name", collation)),
    }


def plain_text(df: DataFrame) -> DataFrame:
    """All texts compared by code point again."""
    return df.select(*[
        F.collate(F.col(f"`{f.name}`"), "UTF8_BINARY").alias(f.name)
        if f.dataType.typeName() == "string" and f.dataType.simpleString() != "string" else F.col(f"`{f.name}`")
        for f in df.schema])
