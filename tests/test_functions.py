import datetime as dt

from starloom.functions import (calendar_columns, date_id, floor_days, null_tokens, title_case,
                                upper_case)


def test_title_case_fixture_cases(spark):
    rows = ["santa barbara d'oeste", "mogi-guacu", "SÃO JOSÉ", "são paulo/sp", "rua 2a", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    got = [r[0] for r in df.select(title_case("c")).collect()]
    assert got == ["Santa Barbara D'Oeste", "Mogi-Guacu", "São José", "São Paulo/Sp", "Rua 2A", "", None]


def test_title_case_matches_python_title(spark):
    words = ["NATION_12", "brand#7", "small ring", "x-ray's o'neil", "ÁGUA branca", "3d printer"]
    df = spark.createDataFrame([(w,) for w in words], "c string")
    got = [r[0] for r in df.select(title_case("c")).collect()]
    assert got == [w.title() for w in words]


def test_upper_and_null_tokens(spark):
    df = spark.createDataFrame([("sp",), ("NA",), ("null",), (None,)], "c string")
    assert [r[0] for r in df.select(upper_case("c")).collect()] == ["SP", "NA", "NULL", None]
    got = [r[0] for r in df.select(null_tokens("c", ["NA", "null"])).collect()]
    assert got == ["sp", None, None, None]


def test_floor_days_fixture_cases(spark):
    rows = [(dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 18)),
            (dt.datetime(2024, 1, 3, 1), dt.datetime(2024, 1, 1, 23)),
            (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 0)),
            (None, dt.datetime(2024, 1, 2, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(floor_days("a", "b")).collect()] == [-2, 1, -1, None]


def test_calendar_fixture_cases(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)],
                               "d date")
    out = df.select(date_id("d").alias("date_id"),
                    *[v.alias(k) for k, v in calendar_columns("d").items()]).collect()
    assert (out[0].date_id, out[0].month_name, out[0].weekday_name) == (20240301, "March", "Friday")
    assert (out[0].year, out[0].quarter, out[0].month, out[0].day) == (2024, 1, 3, 1)
    assert (out[1].weekday, out[1].is_weekend) == (1, False)
    assert (out[2].weekday, out[2].is_weekend, out[2].weekday_name) == (7, True, "Sunday")


def test_date_id_of_timestamp_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 12, 31, 23, 59, 59),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(date_id("t")).collect()] == [19991231, None]


from hypothesis import given, settings, strategies as st  # noqa: E402

_ALPHABET = "abcxyzABCXYZáéíóúãõçÁÉÃÇ '-/#_0123456789"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=24), min_size=1, max_size=20))
def test_title_case_property(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "c string")
    got = [r[0] for r in df.select(title_case("c")).collect()]
    assert got == [w.title() for w in words]
