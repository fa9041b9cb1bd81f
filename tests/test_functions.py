from __future__ import annotations

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coffer.functions import dates, numbers, text


def one_column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")


def apply(spark, values, expression):
    return [r[1] for r in rows(one_column(spark, values).select("i", expression), "i")]


AMOUNTS = ["61,000", "(61,000)", "", "abc", "₫5", "nan", "1e3", "61000.9", "Infinity", None, " 7 ", "12d", "--5", "-(5)",
           "5.", ".5", "+5", ".", "\u00a07\t", "1 2", "0x10"]


def test_accounting_number_flags_what_is_no_plain_number(spark):
    got = apply(spark, AMOUNTS, numbers.accounting_number(F.col("c")))
    assert got == [61000.0, -61000.0, None, None, None, None, 1000.0, 61000.9, None, None, 7.0, None, None, None, 5.0,
                   0.5, 5.0, None, 7.0, None, None]


def test_accounting_number_node_mode_strips_stray_characters(spark):
    got = apply(spark, ["₫5", "(1,200 VND)", "abc", "", "(-3)", "1.2.3"], numbers.accounting_number(F.col("c"), "node"))
    assert got == [5.0, -1200.0, None, None, 3.0, None]


def test_numbers_of_any_length_and_exponent(spark):
    values = ["1e100", "1E-5", "9" * 300, "1" * 400, "5" * 250 + "e99", "-1e400", "0." + "0" * 400 + "1", "1e99999999999"]
    got = apply(spark, values, numbers.accounting_number(F.col("c")))
    assert got == [1e100, 1e-5, float("9" * 300), None, None, None, 0.0, None]


def test_headers_that_become_equal_stay_apart(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], ["Sub Category", "SUB_CATEGORY", " sub  category ", "sub_category_2"])
    assert text.snake_headers(df).columns == ["sub_category", "sub_category_3", "sub_category_4", "sub_category_2"]
    assert text.lower_headers(df).columns[:2] == ["sub category", "sub_category"]


def test_whole_amount_truncates_or_rounds(spark):
    values = ["61,000", "61000.9", "-2.5", "2.5", "", "abc", None, "1e400", "nan"]
    assert apply(spark, values, numbers.whole_amount(F.col("c"))) == [61000, 61000, -2, 2, 0, 0, 0, 0, 0]
    assert apply(spark, values, numbers.whole_amount(F.col("c"), "half_up")) == [61000, 61001, -2, 3, 0, 0, 0, 0, 0]


def test_parse_date_takes_three_formats_in_any_order(spark):
    values = ["10/1/2023", "2023-10-01", "25/12/2023", "", "n/a", " 2023-10-01 ", "2023-10-01 13:05:00", "2023-02-30", None,
              "2023-10-01 25:00:00", "2023-10-01 x", "2023", "2023-10", "10/1/23", "10/1/2023/", "2023-10-1", "\u00a010/01/2023\t"]
    first = date(2023, 10, 1)
    want = [first, first, None, None, None, first, first, None, None, None, None, None, None, None, None, first, first]
    assert apply(spark, values, dates.parse_date(F.col("c"))) == want
    assert apply(spark, values[::-1], dates.parse_date(F.col("c"))) == want[::-1]


def test_month_helpers(spark):
    df = spark.createDataFrame([(2024, 3)], "yr int, mo int")
    yr, mo = F.col("yr"), F.col("mo")
    got = df.select(dates.month_label(yr, mo), dates.first_of_month(yr, mo), dates.month_number(yr, mo)).first()
    assert tuple(got) == ("Mar 2024", date(2024, 3, 1), 2024 * 12 + 3)


def test_trim_removes_every_kind_of_space(spark):
    assert apply(spark, ["  a b\t\n", "　x\x1f", None, " "], text.trim(F.col("c"))) == ["a b", "x", None, ""]


def test_is_true(spark):
    values = ["TRUE ", "1", "yes", "Yes", "no", "", None, "y"]
    assert apply(spark, values, text.is_true(F.col("c"))) == [True, True, True, True, False, False, False, False]


def test_headers(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], [" Sub  Category ", "DATE", "_c2", "  "])
    assert text.lower_headers(df).columns == ["sub  category", "date", "_c2", ""]
    assert text.snake_headers(text.drop_nameless(df)).columns == ["sub_category", "date"]


@pytest.mark.parametrize("names, numeric", [(["0", "1", "2"], True), (["0", "1.0"], True), (["0", "date"], False), ([], False)])
def test_headers_look_numeric(names, numeric):
    assert text.headers_look_numeric(names) is numeric
