"""healthmart: a Spark-native health-data mart.

Cleans, encodes and enriches appointment records and disease/symptom
profiles with DataFrame operators, conforms them to one layout, checks
data quality, builds a star schema (one fact, three dimensions) and
answers a fixed report set over it. Every operator is a Spark plan; no
Python UDF runs anywhere.
"""

__version__ = "0.1.0"
