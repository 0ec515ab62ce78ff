"""Orders as line-list rows and as rows of an earlier report (Spark side).

Every order stands for one listed patient, so all status rules meet many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.bindings.tables import PICKUP_END, table
from carelens.functions import format_date, retention_outcome

# Regimen lines by priority of the order.
LINES = ("Adult 1st line ARV regimen", "Adult 2nd line ARV regimen",
         "Child 1st line ARV regimen", "Child 3rd line ARV regimen", "Other line")


def _instant(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    elapsed = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return rows.withColumns({
        "rank": F.substring("o_orderpriority", 1, 1).cast("int"),
        "pickup": F.date_add(F.lit("2001-01-01").cast("date"), F.floor(elapsed / 13).cast("int")),
    })


def line_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir)
    price, balance = F.col("o_totalprice"), F.col("c_acctbal")
    home, rank, status = F.col("c_nationkey"), F.col("rank"), F.col("o_orderstatus")
    pickup = F.when(price >= 5000, F.col("pickup"))
    days = F.when((status != "P") | (rank != 4), F.floor(price / 4000).cast("int"))
    none = F.lit(None)
    line = F
    for i, name in enumerate(LINES):
        line = line.when(rank == i + 1, name)
    return rows.select(
        F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("uuid"),
        F.concat(F.lit("State "), home.cast("string")).alias("State"),
        F.concat(F.lit("LGA "), home.cast("string")).alias("LGA"),
        F.col("c_mktsegment").alias("FaciityName"),
        F.lpad(F.floor(F.col("o_orderkey") / 2).cast("string"), 7, "0").alias("PatientHospitalNo"),
        F.when(price > 250000, F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("PatientUniqueID"),
        F.when(status == "F", "F").when(status == "O", "M").otherwise("X").alias("Sex"),
        F.date_add(F.lit("1960-01-01").cast("date"), home * 300).alias("DOB"),
        _instant(F.date_add(F.lit("1995-01-01").cast("date"), home)).alias("EnrollmentDate"),
        F.when(rank == 1, "Transfer in with records").when(rank == 2, "Transfer in without records")
        .alias("TransferInStatus"),
        _instant(F.when(home < 8, pickup).otherwise(F.date_sub(pickup, 400))).alias("ARTStartDate"),
        _instant(pickup).alias("LastPickupDate"),
        days.alias("DaysOfARVRefil"),
        _instant(F.when(home <= 20, F.date_sub(pickup, 90))).alias("LastPickupDatePreviousQuarter"),
        F.when(balance >= 0, F.floor(balance / 100).cast("int")).alias("DrugDurationPreviousQuarter"),
        line.alias("InitialRegimenLine"),
        F.concat(F.lit("REG-"), home.cast("string")).alias("InitialRegimen"),
        line.otherwise("Unknown line").alias("CurrentRegimenLine"),
        F.concat(F.lit("REG-"), rank.cast("string")).alias("CurrentRegimen"),
        F.when(status == "F", "Not pregnant").otherwise("").alias("PregnancyStatus"),
        F.when(rank != 3, price / 250).alias("CurrentViralLoad(c/ml)"),
        F.when(status != "F", format_date(F.date_sub(pickup, 30))).alias("ViralLoadReportedDate"),
        F.when(home < 15, F.date_sub(pickup, rank * 10)).alias("LastViralLoadDate"),
        F.when(rank < 4, F.date_sub(pickup, 40)).alias("LastDateOfSampleCollection"),
        (price / 8000).alias("CurrentWeight_Kg"),
        _instant(F.when(home < 12, F.date_sub(pickup, 60))).alias("LastINHDispensedDate"),
        F.when(home == 3, format_date(pickup)).alias("OTZStartDate"),
        F.when(rank != 5, retention_outcome(pickup, days, PICKUP_END)).when(status == "F", "Death")
        .when(status == "O", "Transferred out").otherwise("Discontinued Care").alias("CurrentARTStatus"),
        _instant(F.when(rank == 5, F.date_add(pickup, 3))).alias("PatientOutcomeDate"),
        F.when((rank == 5) & (status == "F"), F.concat(F.lit("Cause "), home.cast("string"))).alias("CauseOfDeath"),
        F.when(rank == 5, "").alias("OtherCauseOfDeath"),
        F.when((rank == 5) & (status == "P"), "Moved").alias("DiscontinuedCareReason"),
        _instant(F.when(balance > 7000, pickup)).alias("DateReturnedToCare"),
        F.when(home < 5, none).when(home < 12, "Active").when(home < 18, "LTFU").otherwise("Death")
        .alias("ARTStatusPreviousQuarter"),
        F.when(home >= 18, F.expr("timestamp_ntz'2001-03-01'")).alias("PatientOutcomeDatePreviousQuarter"),
        F.when(balance < 1000, none).when(balance < 5000, "Active").when(balance < 8000, "LTFU")
        .when(balance < 8500, "Death").when(balance < 9000, "Transferred out")
        .otherwise("Discontinued Care").alias("PreviousARTStatus"),
        F.when(balance >= 3000, F.expr("timestamp_ntz'2001-01-15'")).alias("PreviousARTStatusDate"),
        F.when(status != "O", "Yes").otherwise("No").alias("BiometricCaptured"),
        F.when(status != "O", F.date_sub(pickup, 100)).alias("BiometricCaptureDate"),
    )


def baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir)
    price, home, rank = F.col("o_totalprice"), F.col("c_nationkey"), F.col("rank")
    status, pickup = F.col("o_orderstatus"), F.col("pickup")
    number = F.floor(F.col("o_orderkey") / 2).cast("string")
    return rows.select(
        F.concat(F.lit("LGA "), home.cast("string")).alias("LGA"),
        F.col("c_mktsegment").alias("Facility"),
        F.when(status != "P", number).otherwise(F.lpad(number, 7, "0")).alias("Hospital Number"),
        F.when(price > 250000, F.col("o_custkey").cast("string")).alias("Unique ID"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("Patient ID"),
        F.when(rank != 1, F.floor(price / 100000).cast("double")).alias("Months of ARV Refill"),
        F.date_sub(pickup, 30).alias("Last Pickup Date (yyyy-mm-dd)"),
        F.when(rank == 1, "Active").when(rank == 2, "IIT").when(rank == 3, "Dead")
        .when(rank == 4, None).otherwise("Active").alias("Current ART Status"),
        F.when(rank != 2, price / 300).alias("Current Viral Load (c/ml)"),
        F.when(home < 20, F.date_sub(pickup, 20)).alias("Date of Current Viral Load (yyyy-mm-dd)"),
        F.date_sub(pickup, 35).alias("Date of Viral Load Sample Collection (yyyy-mm-dd)"),
        F.concat(F.lit("CM "), home.cast("string")).alias("Case Manager"),
        F.when(home < 10, "").otherwise("Facility").alias("ART Enrollment Setting"),
        F.date_sub(pickup, 200).alias("Date Commenced DMOC (yyyy-mm-dd)"),
        F.concat(F.lit("MMD"), rank.cast("string")).alias("Type of DMOC"),
        F.when(rank == 1, F.date_sub(pickup, 150))
        .alias("Date of Return of DMOC Client to Facility (yyyy-mm-dd)"),
        F.when(home >= 8, F.date_sub(pickup, 50)).alias("Date of TPT Start (yyyy-mm-dd)"),
        F.lit("3HP").alias("TPT Type"),
        F.date_add(pickup, 30).alias("TPT Completion date (yyyy-mm-dd)"),
    )
