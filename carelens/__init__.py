"""As-of patient line lists and programme reports as Spark DataFrames.

The library works on an entity-attribute-value clinical record: a fact table of
observations (person, concept, instant, typed value slots) with its encounters,
identifiers and coded names.  Every operator takes DataFrames and returns a lazy
DataFrame; nothing here collects rows to the driver.
"""
