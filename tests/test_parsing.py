from __future__ import annotations

from aqarlens.functions.parsing import flag_to_int, parse_amount, parse_room_count
from aqarlens.operators.cleaning import DROP_COLUMNS, payment_method_expr, standardize_payment_method


def _one_column(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_contact_columns_are_dropped():
    assert {"contact_phone", "agent_email", "broker_phone"} <= set(DROP_COLUMNS)


def test_room_text_edge_values(spark):
    values = [" 3 ", "3.", ".5", "-3", "1e3", "7+", "STUDIO", " Studio ", "", None, "2.5"]
    df = _one_column(spark, values)
    got = [r[0] for r in df.select(parse_room_count("x", df.schema["x"].dataType)).collect()]
    assert got == [3.0, 3.0, None, None, None, 7.0, 1.0, 1.0, None, None, 2.5]
    baths = [r[0] for r in df.select(parse_room_count("x", df.schema["x"].dataType, allow_studio=False)).collect()]
    assert baths[6] is None and baths[5] == 7.0


def test_numeric_rooms_are_cast_not_parsed(spark):
    df = _one_column(spark, [3, None], "int")
    assert [r[0] for r in df.select(parse_room_count("x", df.schema["x"].dataType)).collect()] == [3.0, None]


def test_amount_text(spark):
    df = _one_column(spark, ["EGP 1,250,000", "1.2.3", "", None, "-500", "Ask for price", "12.5 sqm"])
    got = [r[0] for r in df.select(parse_amount("x", df.schema["x"].dataType)).collect()]
    assert got == [1250000.0, None, None, None, 500.0, None, 12.5]


def test_numeric_amounts_keep_their_value(spark):
    ints = _one_column(spark, [12_500_000], "bigint")
    doubles = _one_column(spark, [1.25e7, 1.0e7], "double")
    assert ints.select(parse_amount("x", ints.schema["x"].dataType)).first()[0] == 12_500_000.0
    got = [r[0] for r in doubles.select(parse_amount("x", doubles.schema["x"].dataType)).collect()]
    assert got == [12_500_000.0, 10_000_000.0]


def test_boolean_flags(spark):
    df = _one_column(spark, ["True", " yes ", "1", "1.0", None, "maybe", "no", "FALSE"])
    assert [r[0] for r in df.select(flag_to_int("x")).collect()] == [1, 1, 1, 0, 0, 0, 0, 0]
    booleans = spark.createDataFrame([(True,), (False,), (None,)], "x boolean")
    assert [r[0] for r in booleans.select(flag_to_int("x")).collect()] == [1, 0, 0]


def test_payment_outcomes_by_words(spark):
    words = {
        "": "unknown", "bank transfer": "unknown", "in CASH only": "cash", "8-year instalment": "unknown",
        "install over 5 years": "installments", "Cash down, then INSTALLMENTS": "both",
    }
    df = _one_column(spark, [None, *words]).withColumnRenamed("x", "payment_method")
    got = {r[0]: r[1] for r in df.select("payment_method", payment_method_expr("payment_method").alias("o")).collect()}
    assert got == {None: "unknown", **words}


def test_payment_method_rules(spark):
    df = _one_column(spark, ["Cash, install plan", "Installments", "installments | cash", " CASH "]).withColumnRenamed(
        "x", "payment_method"
    )
    got = [r[0] for r in standardize_payment_method(df).collect()]
    assert got == ["both", "installments", "both", "cash"]
