"""CSV headers, quotes and file order; NOT IN with NULLs."""

from pyspark.sql import types as T

from healthmart.operators.clean import dedupe_keep_first
from healthmart.operators.quality import orphans
from healthmart.sources import files

SCHEMA = T.StructType([T.StructField("Disease", T.StringType()), T.StructField("Gender", T.StringType()),
                       T.StructField("Age", T.IntegerType())])


def test_columns_by_header_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Gender,Age,Disease\nMale,3,"say ""hi"", ok"\nFemale,4,"two\nlines"\n')
    rows = files.read_csv(spark, str(tmp_path), schema=SCHEMA).orderBy("Age").collect()
    assert [tuple(r) for r in rows] == [('say "hi", ok', "Male", 3), ("two\nlines", "Female", 4)]


def test_first_row_follows_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,first\n")
    (tmp_path / "b.csv").write_text("k,v\n1,second\n" + "".join(f"{i},x\n" for i in range(2, 500)))
    df = files.with_row_order(files.read_csv(spark, str(tmp_path), infer=True))
    assert dedupe_keep_first(df, ["k"], ["_row"]).where("k = 1").first()["v"] == "first"


def test_not_in(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert [r[0] for r in orphans(fact, spark.createDataFrame([(1,)], "k int"), "k").collect()] == [2]
    assert orphans(fact, spark.createDataFrame([(1,), (None,)], "k int"), "k").count() == 0
    assert orphans(fact, spark.createDataFrame([], "k int"), "k").count() == 3


def test_export_keeps_going_on_an_empty_message(spark, tmp_path):
    def bad():
        raise ValueError()
    out = files.export_reports({"bad": bad, "good": spark.range(2)}, str(tmp_path), spark=spark).collect()
    assert [(r["name"], r["status"]) for r in out] == [("bad", "failed"), ("good", "ok")]
