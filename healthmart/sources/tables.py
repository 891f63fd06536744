"""Driver tables and the role views that feed the mart from them.

The mart's two inputs are an appointments table and a disease-profile
table. On the TPC-H-style tables they are played by:

* appointments  <- lineitem JOIN orders (one row per line item)
* disease profiles <- part (one row per part)

The views only rename and derive columns with built-in expressions, so
every operator downstream runs unchanged on either the medical CSVs or
these tables, and the work grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _yes_no(cond: Column) -> Column:
    return F.when(cond, "Yes").otherwise("No")


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointment role view over lineitem JOIN orders.

    AppointmentID = l_orderkey * 8 + l_linenumber (line numbers are 1..7),
    which repeats exactly where (l_orderkey, l_linenumber) does. Order
    date = scheduled day, ship date = appointment day, quantity = age,
    line status O/F = gender M/F, return flag R = no-show; three flags
    derived from discount, tax and quantity play the comorbidity inputs.
    Only the needed columns are read (pruned at the scan); the join is
    the one shuffle, on the order key.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").alias("PatientId"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("AppointmentID"),
        F.when(F.col("l_linestatus") == "O", "M").when(F.col("l_linestatus") == "F", "F")
         .otherwise(F.col("l_linestatus")).alias("Gender"),
        F.col("o_orderdate").alias("ScheduledDay"),
        F.col("l_shipdate").alias("AppointmentDay"),
        F.col("l_quantity").alias("Age"),
        F.col("o_orderpriority").alias("Neighbourhood"),
        (F.col("l_discount") > 0.05).cast("int").alias("Hipertension"),
        (F.col("l_tax") > 0.04).cast("int").alias("Diabetes"),
        (F.col("l_quantity") > 25).cast("int").alias("Alcoholism"),
        _yes_no(F.col("l_returnflag") == "R").alias("No-show"),
    )


def disease_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disease-profile role view over part: brand = disease, size = age,
    the rest derived from type, name, size and price."""
    p = table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    name, typ, size, price = F.col("p_name"), F.col("p_type"), F.col("p_size"), F.col("p_retailprice")
    return p.select(
        F.col("p_brand").alias("Disease"),
        _yes_no(size > 25).alias("Fever"),
        _yes_no(price >= 950).alias("Cough"),
        _yes_no(typ.isin("ECONOMY", "PROMO", "SMALL")).alias("Fatigue"),
        _yes_no(name.startswith("hot ") | name.startswith("cold ")).alias("Difficulty Breathing"),
        size.alias("Age"),
        F.when(typ.isin("ECONOMY", "LARGE", "MEDIUM"), "Female").otherwise("Male").alias("Gender"),
        F.when(price < 910, "Low").when(price < 960, "Normal").otherwise("High").alias("Blood Pressure"),
        F.when(size <= 10, "Low").when(size <= 30, "Normal").otherwise("High").alias("Cholesterol Level"),
        F.when(name.endswith(" gear") | name.endswith(" ring") | name.endswith(" rod") | name.endswith(" bolt"),
               "Positive").otherwise("Negative").alias("Outcome Variable"),
    )


# The same role views as DuckDB SQL, for the oracle side of the checks.
APPOINTMENTS_SQL = """
SELECT o.o_custkey AS "PatientId",
       CAST(l.l_orderkey * 8 + l.l_linenumber AS BIGINT) AS "AppointmentID",
       CASE WHEN l.l_linestatus = 'O' THEN 'M' WHEN l.l_linestatus = 'F' THEN 'F' ELSE l.l_linestatus END AS "Gender",
       o.o_orderdate AS "ScheduledDay",
       l.l_shipdate AS "AppointmentDay",
       l.l_quantity AS "Age",
       o.o_orderpriority AS "Neighbourhood",
       CAST(l.l_discount > 0.05 AS INTEGER) AS "Hipertension",
       CAST(l.l_tax > 0.04 AS INTEGER) AS "Diabetes",
       CAST(l.l_quantity > 25 AS INTEGER) AS "Alcoholism",
       CASE WHEN l.l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS "No-show"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

PROFILES_SQL = """
SELECT p_brand AS "Disease",
       CASE WHEN p_size > 25 THEN 'Yes' ELSE 'No' END AS "Fever",
       CASE WHEN p_retailprice >= 950 THEN 'Yes' ELSE 'No' END AS "Cough",
       CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'Yes' ELSE 'No' END AS "Fatigue",
       CASE WHEN p_name LIKE 'hot %' OR p_name LIKE 'cold %' THEN 'Yes' ELSE 'No' END AS "Difficulty Breathing",
       p_size AS "Age",
       CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'MEDIUM') THEN 'Female' ELSE 'Male' END AS "Gender",
       CASE WHEN p_retailprice < 910 THEN 'Low' WHEN p_retailprice < 960 THEN 'Normal' ELSE 'High' END AS "Blood Pressure",
       CASE WHEN p_size <= 10 THEN 'Low' WHEN p_size <= 30 THEN 'Normal' ELSE 'High' END AS "Cholesterol Level",
       CASE WHEN p_name LIKE '% gear' OR p_name LIKE '% ring' OR p_name LIKE '% rod' OR p_name LIKE '% bolt'
            THEN 'Positive' ELSE 'Negative' END AS "Outcome Variable"
FROM part
"""
