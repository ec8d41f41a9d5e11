"""Value, phase, status and label-set expressions."""

import hashlib

from pyspark.sql import functions as F

from snaptrail.functions import values


def evaluated(spark, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_reliable(spark):
    inputs = ["x", "", None, "<unavailable>", "<null>", "<not-set>", "<NULL>"]
    assert evaluated(spark, inputs, values.is_reliable) == [True, True, False, False, False, False, True]


def test_status_ignores_case_and_null_is_other(spark):
    inputs = ["True", "ENABLED", "1", "on", "False", "disabled", "0", "OFF", "x", None, "<null>"]
    expected = ["ENABLED"] * 4 + ["DISABLED"] * 4 + ["OTHER"] * 3
    assert evaluated(spark, inputs, values.status) == expected


def test_preview_is_case_sensitive(spark):
    inputs = ["BETA", "PreviewPhase.BETA", "ga", "GA", "PreviewPhase.GA", "None", "", None]
    assert evaluated(spark, inputs, values.is_preview) == [True, True, True] + [False] * 5


def test_labels_version_is_the_hash_of_the_sorted_labels(spark):
    expected = hashlib.sha256(b"ML|b|c").hexdigest()[:12]

    def version(labels):
        return spark.range(1).select(values.labels_version(values.label_array(labels))).first()[0]

    assert version(["c", " b ", "ML"]) == version(["ML", "c", "b"]) == version(" b,c ,,ML") == expected
    assert version(["ML", "b"]) != expected
