import math

import pytest
from pyspark.sql import functions as F

from conceptloom.functions import text as t
from conceptloom.functions import vectors as v


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "value,want",
    [("0.5", 0.5), (" .25 ", 0.25), ("abc", 0.8), ("0.9f", 0.8), ("1_0", 1.0), ("nan", 1.0), ("-1", 0.0), ("7", 1.0), ("", 0.8), (None, 0.8), ("1e-1", 0.1)],
)
def test_confidence(spark, value, want):
    assert one(spark, value, t.confidence_of("x")) == want


def test_blanks_and_white_space(spark):
    assert one(spark, "\t A    b ", t.name_form("x")) == "a b"
    assert one(spark, "  ID \t", t.id_form("x")) == "id"
    assert one(spark, "  a \x0b", t.strip_white("x")) == "a"
    assert one(spark, "  a  b c ", t.words("x")) == ["a", "b", "c"]
    assert one(spark, "a\r\nb c\x1cd", t.lines("x")) == ["a", "b", "c", "d"]
    assert one(spark, None, t.name_form("x")) is None


def test_names_and_replies(spark):
    assert one(spark, " Éclair! ", t.normal_name("x")) == "clair"
    assert one(spark, "हिन्दी!", t.normal_name("x", ascii_only=False)) == "हिन्दी"
    assert one(spark, "<think>a\nb</think> yes", t.think_stripped("x")) == "yes"
    assert [one(spark, x, t.digits_clamped("x")) for x in ("4/5", "n/a", "0", "3")] == [5, 2, 1, 3]
    assert one(spark, "/a/b.c/d.E.TXT", t.path_suffix("x")) == ".txt"
    assert one(spark, "/a/b.c/d.E.TXT", t.path_stem("x")) == "d.E"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    r = df.select(v.dot("a", "b").alias("d"), v.norm("a").alias("n"), v.cosine("a", "b").alias("c"), v.unit("a").alias("u"), v.distance("a", "b").alias("e")).first()
    assert (r.d, r.n, r.c, r.u) == (24.0, 5.0, 0.96, [0.6, 0.8]) and math.isclose(r.e, math.sqrt(2))
    assert spark.createDataFrame([([0.0],)], "a array<float>").select(v.cosine("a", "a").alias("c"), v.unit("a").alias("u")).first().u == [0.0]


def test_runtime_scratch(spark):
    from conceptloom.runtime import Scratch, fingerprint

    s = Scratch(spark, "t")
    a = s.save(spark.range(10), "a")
    assert fingerprint(a) == fingerprint(spark.range(9, -1, -1)) and a.count() == 10
    assert fingerprint(spark.range(0)) == (0, 0)
    s.drop()
    assert F is not None
