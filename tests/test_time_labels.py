"""P3 P4 T4 T5."""

from pyspark.sql import functions as F

from pulse.functions import labels as LB
from pulse.functions import time as TM


def test_epoch_to_iso(spark):
    df = spark.createDataFrame([(1748178000.0,)], "e double")
    assert df.select(TM.iso_utc(TM.epoch_to_utc("e"))).first()[0] == "2025-05-25T13:00:00+00:00"


def test_bad_time_is_null_only_for_that_row(spark):
    df = spark.createDataFrame([("2025-05-25T13:00:00Z",), ("yesterday",), ("2025-05-26T01:02:03Z",)], "t string")
    got = [r[0] for r in df.select(TM.iso_utc(TM.parse_utc("t"))).collect()]
    assert got == ["2025-05-25T13:00:00+00:00", None, "2025-05-26T01:02:03+00:00"]


def test_extract_label_modes(spark):
    cases = ["Very Positive", "very positive", "none of these", "Negative", "Positive, not Very Negative"]
    df = spark.createDataFrame([(c,) for c in cases], "a string")
    got = df.select(LB.extract_label("a", "longest"), LB.extract_label("a", "scale_order")).collect()
    assert [tuple(r) for r in got] == [
        ("Very Positive", "Positive"),
        ("Neutral", "Neutral"),
        ("Neutral", "Neutral"),
        ("Negative", "Negative"),
        ("Positive", "Very Negative"),
    ]


def test_label_ordinal_roundtrip(spark):
    df = spark.createDataFrame([("Very Negative",), ("Positive",), ("bogus",), (None,)], "l string")
    got = [tuple(r) for r in df.select(LB.label_to_ordinal("l"), LB.ordinal_to_label(LB.label_to_ordinal("l")),
                                       LB.label_colour("l")).collect()]
    assert got == [(0, "Very Negative", "darkred"), (3, "Positive", "lightgreen"),
                   (2, "Neutral", "gray"), (2, "Neutral", "gray")]
    assert spark.range(1).select(LB.ordinal_to_label(F.lit(9))).first()[0] == "Neutral"
