"""U2/U3 normalisers and their traps."""

from pyspark.sql import functions as F

from siftkit.functions.text import edit_distance_within, nfkc, norm_dict, norm_str


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_norm_str_traps(spark):
    values = ["ＳＯＮＹ", "ﬁ", "ℌ", "  a  b ", "日本語", "", None, "Brand#2", "Samsung  Galaxy!"]
    assert _apply(spark, norm_str, values) == ["sony", "fi", "", "a b", "", "", None, "brand 2", "samsung galaxy"]


def test_norm_dict_keeps_reference_order(spark):
    # non [a-z0-9 ] replaced before lower-casing, no trim: capitals become spaces
    assert _apply(spark, norm_dict, ["Samsung", "samsung ", "ＳＯＮＹ", "ｓｏｎｙ"]) == [" amsung", "samsung ", "    ", "sony"]


def test_nfkc_only_changes_non_ascii(spark):
    assert _apply(spark, nfkc, ["abc", "ﬁ", "①", None]) == ["abc", "fi", "1", None]


def test_edit_distance_within(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("abc", "abd")], "a string, b string")
    got = [r.d for r in df.select(edit_distance_within(F.col("a"), F.col("b"), 2).alias("d")).collect()]
    assert got == [None, 1]
