import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.functions import arrays
from tabloom.functions import scalars as sc
from tabloom.functions.tails import t_two_sided
from tabloom.operators.relational import scale_unit


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column).first()[0]


def test_band_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (90.0,), (90.1,), (120.0,), (300.0,), (301.0,), (None,)], "v double")
    labels = ["slow", "medium", "lively", "fast"]
    got = [r[0] for r in df.select(sc.band("v", [0, 90, 120, 150, 300], labels)).collect()]
    assert got == [None, "slow", "medium", "medium", "fast", None, None]


def test_points(spark):
    df = spark.createDataFrame([(0, 0), (0, 5), (3, 0), (2, 4), (None, 1)], "x int, y int")
    got = [r[0] for r in df.select(sc.describe_point("x", "y")).collect()]
    assert got == ["origen", "eje Y en 5", "eje X en 3", "punto (2, 4)", "no es un par de coordenadas"]


def test_parsing(spark):
    df = spark.createDataFrame([(" 12 ",), ("3.7",), ("x",), ("",), (None,), ("nan",), ("0,80",)], "t string")
    rows = df.select(sc.parse_int("t"), sc.parse_number("t"), sc.decimal_comma("t")).collect()
    assert [r[0] for r in rows] == [12, None, None, None, None, None, None]
    assert [r[1] for r in rows] == [12.0, 3.7, None, None, None, None, None]
    assert rows[6][2] == 0.8


def test_recode_keeps_the_rest(spark):
    df = spark.createDataFrame([("regeton",), ("pop",), (None,)], "g string")
    assert [r[0] for r in df.select(sc.recode("g", {"regeton": "reggaeton"})).collect()] == ["reggaeton", "pop", None]


def test_lengths(spark):
    text = "café ☕ 数据"
    assert one(spark, F.char_length("t"), t=text) == 9
    assert one(spark, F.octet_length("t"), t=text) == 16


def test_mojibake(spark):
    df = spark.createDataFrame([("clásica ☕",), ("clÃ¡sica",), ("plain",), ("ña",), (None,)], "t string")
    rows = df.select(sc.is_mojibake("t"), sc.repair_mojibake("t")).collect()
    assert [r[0] for r in rows] == [False, True, False, False, False]
    assert [r[1] for r in rows] == ["clásica ☕", "clásica", "plain", "ña", None]


def test_close_to(spark):
    assert one(spark, sc.close_to(F.lit(0.1) + F.lit(0.2).cast("double"), F.lit(0.3).cast("double")))
    assert not one(spark, sc.close_to(F.lit(1.0), F.lit(1.001)))


def test_rounding(spark):
    assert one(spark, sc.round_even(F.lit(2.5), 0)) == 2
    assert one(spark, F.round(F.lit(2.5), 0)) == 3


def test_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [1.0])], "a array<double>, b array<double>, c array<double>")
    row = df.select(arrays.item("a", 0), arrays.item("a", -1), arrays.item("a", 9), arrays.add("a", "b"), arrays.scale("a", 2)).first()
    assert tuple(row) == (1.0, 3.0, None, [5.0, 7.0, 9.0], [2.0, 4.0, 6.0])
    with pytest.raises(Exception, match="unequal length"):
        df.select(arrays.add("a", "c")).collect()


def test_t_tail_against_known_values(spark):
    df = spark.createDataFrame([(2.0, 10.0), (12.706205, 1.0), (2.776445, 4.0), (1.959964, 1e6)], "t double, df double")
    got = [r[0] for r in df.select(t_two_sided(F.col("t"), F.col("df"))).collect()]
    assert got == pytest.approx([0.073388, 0.05, 0.05, 0.05], abs=2e-6)


def test_scale_unit_cases(spark):
    def scaled(values):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        return sorted(r[0] for r in scale_unit(df, "v").collect())

    assert scaled([0, 5, 10]) == [0.0, 0.5, 1.0]
    assert scaled([7, 7, 7]) == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        scaled([])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=20))
def test_scale_unit_stays_in_range(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(0.0 <= r[0] <= 1.0 for r in scale_unit(df, "v").collect())
