import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977} the{i % 13}" for i in range(20_000))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("shard", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("class", T.StringType()), T.StructField("p_toxic", T.DoubleType()),
    T.StructField("blob", T.StringType())])


def row(doc_id, text, source="a"):
    return (doc_id, text, source, 7, "own", "own", "own", 0.5, "own")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing column names."""
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [row(1, None), row(2, ""), row(3, " \n\t "), row(4, LONG, None), row(5, same), row(5, same),
            row(6, same, None), row(None, same), row(None, None, None), row(7, "short"),
            row(8, "ÀÉ mixed Ünïcode — text 漢字 😀 end"), row(-9, same + " thirteen", "b")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

