"""Test tables as observations, pickups and clinical tables (Spark side).

``events`` become stand-alone observations, ``orders`` with ``lineitem`` become
pickups with their refill children, and all tables together become a full clinical
record for the line list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators.latest import preferred_names
from carelens.sources.tables import SCHEMAS

OBS_END = "2024-01-20"
UNBOUNDED_END = "2024-01-29"
PICKUP_END = "2001-06-30"
START = "2000-07-01"
NOW = "2001-07-05"

# Coded answers by nation, and what some of them are called.
CODES = (
    165681, 165682, 165688, 165691, 165692, 165697, 165699, 166187, 166194, 166196,
    166197, 166198, 1679, 900013, 900014, 900015, 900016, 900017, 900018, 900019,
    900020, 900021, 900022, 900023, 900024,
)
ANSWER_NAMES = {
    12: "Isoniazid",
    13: "Death",
    14: "Transferred out",
    15: "Discontinued Care",
    16: "Transfer in with records",
    17: "Adult 1st line ARV regimen",
    18: "Adult 2nd line ARV regimen",
    19: "Child 1st line ARV regimen",
    20: "Child 2nd line ARV regimen",
    21: "Adult 3rd line ARV regimen",
}
# Concepts of the observations made from events.
EVENT_CONCEPTS = (
    159599, 165242, 165050, 856, 165414, 159951, 5089, 5090, 1659, 164852, 166096,
    165727, 1113, 159431, 166156, 166158, 165460, 165469, 165889, 165915, 165775,
    165776, 160540, 160554, 160534,
)
CHILD_IDS = 1_000_000_000_000
EVENT_IDS = 2_000_000_000_000


# The test tables used here; a given schema spares a look at the files.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("obs_id"),
        F.col("user_id").alias("person_id"),
        F.col("event_type").alias("concept_id"),
        F.col("ts").alias("obs_datetime"),
        F.col("value").alias("value_numeric"),
        F.floor(_k() / 4).cast("int").alias("value_coded"),
        F.col("event_id").alias("encounter_id"),
        (F.col("value") < 5).cast("int").alias("voided"),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the encounters of these observations."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("encounter_id"),
        F.col("user_id").alias("patient_id"),
        F.when(_k() < 34, 13).otherwise(27).alias("form_id"),
        F.when(_k().between(20, 70), 13).otherwise(11).alias("encounter_type"),
        F.col("ts").alias("encounter_datetime"),
        (F.col("value") > 200).cast("int").alias("voided"),
    )


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the preferred names of coded answers."""
    return preferred_names(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("concept_id"), F.col("n_name").alias("name"),
        F.lit("en").alias("locale"), F.lit(1).alias("locale_preferred")))


def pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as medication pickups."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("obs_id"),
        F.col("o_orderdate").alias("obs_datetime"),
        (F.col("o_totalprice") < 20000).cast("int").alias("voided"),
        F.when(F.col("o_orderstatus") == "P", 13).otherwise(27).alias("form_id"),
        F.col("o_orderkey").alias("encounter_id"),
        F.lit(1).alias("concept_id"),
    )


def refills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refill days per order: seven times its largest line quantity."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("group_id")).agg(
        (F.max("l_quantity") * 7).cast("int").alias("child_value"))


def _code(position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CODES]), position + 1)


def _rows(df: DataFrame, *structs: Column) -> DataFrame:
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Columns and types of a clinical table; columns not given are NULL."""
    fields = [f.strip().split(" ") for f in SCHEMAS[name].split(",")]
    return df.select([
        (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def clinical_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "at", F.col("o_orderdate") + F.when(
            F.col("o_orderstatus") == "O", F.expr("interval 9 hours")).otherwise(F.expr("interval 0 hours")))
    price, priority, tracked = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus") == "P"
    band = F.floor(price / 20001).cast("int")

    def by_priority(*values: Column) -> Column:
        chain = F
        for rank, value in zip(("1-", "2-", "3-", "4-"), values[:4], strict=True):
            chain = chain.when(priority.startswith(rank), value)
        return chain.otherwise(values[4])

    lit = F.lit
    extra_concept = F.when(tracked, by_priority(
        F.when(price > 300000, 165470).otherwise(165889), lit(165469), lit(165460), lit(165775),
        lit(165916))).otherwise(by_priority(
            lit(160540), lit(165242), lit(5089), lit(1659), lit(165727)))
    ending = F.when(price < 370000, 13).when(price < 440000, 14).otherwise(15)
    extra_code = F.when(tracked, by_priority(_code(ending), lit(None), _code(band), lit(None), lit(None))
                        ).otherwise(by_priority(_code(band), _code(lit(16)), lit(None), _code(band),
                                                _code(F.when(price > 250000, 12).otherwise(11))))

    def row(offset: int, concept: Column, code: Column, number: Column | None = None,
            instant: Column | None = None, text: Column | None = None) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 4 + offset).alias("obs_id"),
            F.col("o_custkey").alias("person_id"), concept.cast("int").alias("concept_id"),
            F.col("o_orderkey").alias("encounter_id"), F.col("at").alias("obs_datetime"),
            (lit(None) if number is None else number).cast("double").alias("value_numeric"),
            code.cast("int").alias("value_coded"),
            (lit(None) if instant is None else instant).cast("timestamp_ntz").alias("value_datetime"),
            (lit(None) if text is None else text).cast("string").alias("value_text"),
            (price < 20000).cast("int").alias("voided"))

    visits = _rows(
        orders,
        row(0, lit(165708), _code(by_priority(lit(17), lit(18), lit(19), lit(20), lit(21)))),
        row(1, lit(162240), lit(None)),
        row(2, by_priority(lit(164506), lit(164513), lit(164507), lit(165702), lit(165703)), _code(band)),
        row(3, extra_concept, extra_code, number=F.floor(price / 5000),
            instant=F.col("at") + F.expr("interval 5 days"), text=F.concat(lit("note "), priority)),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").alias("q"))
    children = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (lit(CHILD_IDS) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("obs_id"),
        F.col("o_custkey").alias("person_id"), lit(159368).alias("concept_id"),
        F.col("o_orderkey").alias("encounter_id"),
        (F.col("o_orderkey") * 4 + 1).alias("obs_group_id"), F.col("at").alias("obs_datetime"),
        (F.col("q") * 3).alias("value_numeric"), (F.col("q") >= 49).cast("int").alias("voided"))

    events = table(spark, sf_dir, "events").withColumns({
        "k": _k(),
        "at": F.col("ts") - F.expr("interval 23 years") + F.expr("interval 165 days")})
    value_band = F.least(F.floor(F.col("value") / 5).cast("int"), lit(24))
    concepts = F.array(*[lit(c) for c in EVENT_CONCEPTS])
    standalone = events.select(
        (lit(EVENT_IDS) + F.col("event_id")).alias("obs_id"),
        F.col("user_id").alias("person_id"),
        F.element_at(concepts, F.floor(F.col("k") / 4).cast("int") + 1).alias("concept_id"),
        F.col("event_id").alias("encounter_id"), F.col("at").alias("obs_datetime"),
        (F.col("value") * 20).alias("value_numeric"),
        _code(F.when(F.col("event_type") == "purchase", 12)
              .when(F.col("event_type") == "signup", 16).otherwise(value_band)).alias("value_coded"),
        F.date_sub(F.col("at").cast("date"), F.col("k")).cast("timestamp_ntz").alias("value_datetime"),
        F.concat("event_type", lit("-"), F.col("k").cast("string")).alias("value_text"),
        (F.col("value") < 2).cast("int").alias("voided"))
    parts = [_conform(p, "obs") for p in (visits, children, standalone)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def clinical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A clinical record made of all test tables."""
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    segment, home = F.col("c_mktsegment"), F.col("c_nationkey")
    lit, flag = F.lit, lambda cond: cond.cast("int")
    number = F.regexp_replace("c_name", "[^0-9]", "")

    def identifier(kind: int, value: Column, prefix: str, voided: Column) -> Column:
        return F.struct(
            key.alias("patient_id"), value.alias("identifier"), lit(kind).alias("identifier_type"),
            F.concat(lit(prefix), key.cast("string")).alias("uuid"), flag(voided).alias("voided"))

    identifiers = _rows(
        customer,
        identifier(5, F.when(segment == "BUILDING", F.lpad(F.floor(key / 2).cast("string"), 6, "0"))
                   .when((segment == "FURNITURE") & (balance < 500), None).otherwise(number),
                   "h-", balance.between(1000, 1200)),
        identifier(4, F.when(home < 20, F.lpad(key.cast("string"), 8, "0")), "u-",
                   balance.between(1200, 1300)),
        identifier(6, F.when(segment == "HOUSEHOLD", F.concat(lit("ANC"), key.cast("string"))),
                   "a-", lit(False)),
        identifier(8, F.when(balance > 5000, F.concat(lit("HTS/"), key.cast("string"))),
                   "t-", lit(False)),
    ).filter(F.col("identifier").isNotNull())

    position = F.col("n_nationkey")
    answer = F
    for place, name in ANSWER_NAMES.items():
        answer = answer.when(position == place, name)
    answer = answer.otherwise(F.col("n_name"))
    concept_names = _rows(nation, *[
        F.struct(_code(position).alias("concept_id"), F.concat(answer, lit(suffix)).alias("name"),
                 lit(locale).alias("locale"), preferred.cast("int").alias("locale_preferred"))
        for suffix, locale, preferred in (
            ("", "en", position != 24), (" (fr)", "fr", lit(1)), (" old", "en", lit(0)))])

    code = F.col("r_regionkey")
    price = F.col("o_totalprice")
    prints = again = orders
    order_text = F.col("o_orderkey").cast("string")
    tables = {
        "patient": customer.select(key.alias("patient_id"), flag(balance < -900).alias("voided")),
        "patient_identifier": identifiers,
        "global_property": region.select(
            F.when(code == 0, "facility_datim_code").when(code == 1, "Facility_Name")
            .otherwise(F.col("r_name")).alias("property"),
            F.col("r_name").alias("property_value")),
        "nigeria_datimcode_mapping": region.select(
            F.col("r_name").alias("datim_code"),
            F.concat("r_name", lit(" State")).alias("state_name"),
            F.concat("r_name", lit(" LGA")).alias("lga_name")),
        "obs": clinical_obs(spark, sf_dir),
        "concept_name": concept_names,
        "encounter": orders.select(
            F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"),
            F.when(F.col("o_orderstatus") == "P", 13).otherwise(27).alias("form_id"),
            F.when(F.col("o_orderpriority") <= "3-MEDIUM", 13).otherwise(11).alias("encounter_type"),
            F.col("o_orderdate").alias("encounter_datetime"),
            (F.col("o_orderdate") + F.expr("interval 1 day")).alias("date_created"),
            F.floor(price / 5000).alias("creator"), flag(price > 490000).alias("voided")),
        "person": customer.select(
            key.alias("person_id"),
            F.when(segment.isin("HOUSEHOLD", "FURNITURE", "BUILDING"), "F").otherwise("M").alias("gender"),
            F.date_add(lit("1950-01-01").cast("date"),
                       F.floor((balance + 1000) * 1.6).cast("int")).alias("birthdate"),
            flag(balance > 9500).alias("dead"),
            F.date_add(lit("2000-01-01").cast("date"), home * 30).cast("timestamp_ntz").alias("death_date"),
            flag(balance.between(9900, 9950)).alias("voided")),
        "person_name": customer.select(
            key.alias("person_id"), segment.alias("given_name"),
            F.when(home != 24, F.col("c_name")).alias("family_name"),
            flag(balance < -800).alias("voided")),
        "person_attribute": customer.select(
            key.alias("person_id"), F.when(home < 22, 8).otherwise(7).alias("person_attribute_type_id"),
            F.concat(lit("080"), number).alias("value"), lit(0).alias("voided")),
        "person_attribute_type": region.select(
            (code + 5).alias("person_attribute_type_id"),
            F.when(code == 3, "Telephone Number").otherwise(F.col("r_name")).alias("name")),
        "person_address": customer.select(
            key.alias("person_id"), F.concat(lit("Ward "), home.cast("string")).alias("address1")),
        "patient_program": customer.select(
            key.alias("patient_id"), F.when(home < 20, 1).otherwise(2).alias("program_id"),
            F.date_add(lit("1995-01-01").cast("date"), home * 10).cast("timestamp_ntz")
            .alias("date_enrolled"), lit(0).alias("voided")),
        "biometricinfo": prints.select(
            F.col("o_custkey").alias("patient_Id"), F.col("o_orderdate").alias("date_created"),
            F.concat(F.when(price > 60000, "Rk1S").otherwise("Zz1S"), order_text).alias("template"),
            F.when(F.col("o_orderstatus") != "O", F.encode(F.concat(
                F.when(price < 440000, "Rk1S").otherwise("Zz1S"), order_text), "UTF-8")
            ).alias("new_template")),
        "biometricverificationinfo": again.select(
            F.col("o_custkey").alias("patient_Id"), F.col("o_orderdate").alias("date_created"),
            F.floor(price / 100000).alias("recapture_count"),
            F.col("o_orderstatus").alias("fingerPosition"),
            F.when(price <= 400000, F.floor(price / 4000)).alias("imageQuality")),
        "users": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("user_id"), F.col("s_suppkey").alias("person_id")),
    }
    return {name: df if name == "obs" else _conform(df, name) for name, df in tables.items()}
