from __future__ import annotations

from datetime import date

import pytest
from conftest import rows

import __spark_entry__ as entry
from coffer.plans.cleaning import clean_expenses, promote_header
from coffer.plans.loading import candidates
from coffer.plans.staging import as_batch, current_rows, stage_append
from coffer.sources import sheets
from coffer.sources.sheets import read_sheet, require_rows, tidy_cells, write_sheet


def sheet(spark, names, data):
    numbered = [(*row, i) for i, row in enumerate(data)]
    return spark.createDataFrame(numbered, ", ".join(f"`{n}` string" for n in names) + ", _row_idx long")


def test_staging_twice_leaves_whole_number_and_blank_keys_once(spark):
    first = as_batch(sheet(spark, ["DATE", "Amount", "Category"], [("10/1/2023", "5", ""), ("10/2/2023", "7", None)]), 1)
    again = as_batch(sheet(spark, ["date", "amount", "category"], [("10/1/2023", "5", None), ("10/2/2023", "7", "")]), 2)
    merged = stage_append(first, again)
    assert merged.columns == ["date", "amount", "category", "_batch_id", "_row_idx"]
    assert {r["_batch_id"] for r in merged.collect()} == {2}
    assert merged.count() == 2


def test_the_last_row_per_key_is_kept_and_new_columns_are_aligned(spark):
    first = as_batch(sheet(spark, ["date", "amount", "note"], [("d", "1", "old"), ("d", "2", "only")]), 1)
    second = as_batch(sheet(spark, ["date", "amount", "extra"], [("d", "1", "x"), ("d", "1", "y")]), 2)
    got = stage_append(first, second).select("date", "amount", "note", "extra")
    assert rows(got) == [("d", "1", None, "y"), ("d", "2", "only", None)]


def test_staging_key_follows_the_source(spark):
    items = as_batch(sheet(spark, ["year", "month", "category"], [("2024", "1", "Food"), ("2024", "2", "Food")]), 1)
    assert current_rows(items, ("year", "month", "category")).count() == 2
    assert current_rows(items).count() == 1  # the general key list has only the category here
    assert current_rows(items, None).count() == 2


def test_staging_headers_keep_inner_spaces(spark):
    assert as_batch(sheet(spark, [" SUB CATEGORY "], [("a",)]), 1).columns[0] == "sub category"


SAMPLE = '''\ufeffDATE,CATEGORY,SUB_CATEGORY,TYPE_PAYMENT,INPUT,OUTPUT,BALANCE,AMOUNT_BALANCE,NOTE,TOTAL EXPENSE MONTHLY
"10/1/2023","Debt","Personal Loans","Loan","6,000,000","","6,000,000","2,214,000","",""
"10/1/2023","Food","Daily meals","Income","","61,000","(61,000)","","two
lines, ""quoted""",""
"x","Food","Others","Income","","1","(1)","","",""

"10/2/2023","Income","Salary"
" ","","","","","","","","",""
'''


def test_sheet_file_with_marks_quotes_short_rows_and_blank_rows(spark, tmp_path):
    (tmp_path / "export.csv").write_text(SAMPLE, encoding="utf-8")
    got = read_sheet(spark, str(tmp_path))
    assert got.columns[0] == "DATE"
    found = rows(got.select("DATE", "CATEGORY", "BALANCE", "NOTE", "_row_idx"), "_row_idx")
    assert [r[:3] for r in found] == [
        ("10/1/2023", "Debt", "6,000,000"),
        ("10/1/2023", "Food", "(61,000)"),
        ("x", "Food", "(1)"),
        ("10/2/2023", "Income", ""),
    ]
    assert found[1][3] == 'two\nlines, "quoted"'


def test_sample_sheet_is_cleaned(spark, tmp_path):
    (tmp_path / "export.csv").write_text(SAMPLE, encoding="utf-8")
    got = clean_expenses(read_sheet(spark, str(tmp_path))).drop("_row_idx")
    assert got.columns == [
        "date", "category", "sub_category", "type_payment", "balance", "note", "needs_cleaning", "source_data",
    ]
    assert rows(got.select("date", "category", "balance", "needs_cleaning")) == [
        (date(2023, 10, 1), "Debt", 6000000.0, False),
        (date(2023, 10, 1), "Food", -61000.0, False),
        (date(2023, 10, 2), "Income", None, True),
    ]


def test_cells_written_as_csv_come_back(spark, tmp_path):
    data = [("a", ' lead "q"\n, x '), ("b", ""), ("c", "\\ back")]
    write_sheet(spark.createDataFrame(data, "k string, v string"), str(tmp_path / "out"))
    assert rows(read_sheet(spark, str(tmp_path / "out")).drop("_row_idx")) == data


def test_blank_rows_go_and_missing_cells_become_blank(spark):
    got = tidy_cells(sheet(spark, ["a", "b"], [("1", None), ("  ", None), (None, None)]))
    assert rows(got.select("a", "b")) == [("1", "")]


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="sheet has no rows"):
        require_rows(spark.createDataFrame([], "a string"), "sheet")
    with pytest.raises(ValueError, match="no date column"):
        clean_expenses(sheet(spark, ["amount"], [("1",)]))


def test_header_only_sheet_cleans_to_nothing(spark):
    assert clean_expenses(sheet(spark, ["DATE", "AMOUNT"], [])).count() == 0


def test_first_row_becomes_header_when_names_are_numbers(spark):
    raw = sheet(spark, ["0", "1", "2"], [("DATE", "Amount", None), ("10/1/2023", "5", "junk")])
    assert promote_header(raw).columns == ["DATE", "Amount", "", "_row_idx"]
    got = clean_expenses(raw)
    assert rows(got.select("date", "amount")) == [(date(2023, 10, 1), 5.0)]
    assert got.columns == ["date", "amount", "needs_cleaning", "source_data", "_row_idx"]


def test_python_mode_flags_and_node_mode_drops(spark):
    names = ["Date", "Amount", "Note", "Output"]
    data = [
        ("10/1/2023", "(61,000)", " a ", "1"),
        ("10/2/2023", "", None, "1"),
        ("10/3/2023", "abc", "c", "1"),
        ("10/4/2023", "₫5", "d", "1"),
        ("25/12/2023", "1", "e", "1"),
    ]
    python = clean_expenses(sheet(spark, names, data))
    assert rows(python.select("amount", "note", "needs_cleaning", "source_data"), "date") == [
        (-61000.0, "a", False, "python-api"),
        (None, "", True, "python-api"),
        (None, "c", True, "python-api"),
        (None, "d", True, "python-api"),
    ]
    node = clean_expenses(sheet(spark, names, data), mode="node")
    assert rows(node.select("date", "amount", "note", "source_data"), "date") == [
        ("2023-10-01", -61000.0, "a", "nodejs"),
        ("2023-10-02", None, None, "nodejs"),
        ("2023-10-04", 5.0, "d", "nodejs"),
    ]


@pytest.mark.parametrize("mode", ["python", "node"])
def test_each_cell_is_parsed_once_whatever_is_filtered_on_it(spark, capsys, mode):
    raw = spark.range(40).selectExpr(
        "concat(id % 12 + 1, if(id % 4 = 0, '-', '/'), '1/2023') AS date",
        "if(id % 5 = 0, 'abc', concat('(1,', 100 + id, ')')) AS amount",
        "'x' AS transaction_type",
        "id AS _row_idx",
    )
    got = clean_expenses(raw, mode)
    got = candidates(got) if mode == "python" else got.filter("amount < -1")
    got.explain()
    assert capsys.readouterr().out.count("regexp_extract(") == 2  # the date and the amount
    assert got.count() == sum(1 for k in range(40) if k % 4 and k % 5)


def order_tables(spark, folder, count=160, files=8):
    """The tables that sheets are derived from, with orders in several files."""
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    nation = spark.createDataFrame([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int")
    nation.write.parquet(f"{folder}/nation.parquet")
    customer = spark.range(5).selectExpr("id AS c_custkey", "0 AS c_nationkey")
    customer.write.parquet(f"{folder}/customer.parquet")
    orders = spark.range(0, count, 1, files).selectExpr(
        "id AS o_orderkey", "id % 5 AS o_custkey", "if(id % 2 = 0, 'F', 'P') AS o_orderstatus",
        "1000.5D + id AS o_totalprice", "timestamp_ntz'1996-03-01 00:00:00' AS o_orderdate", "'5-LOW' AS o_orderpriority",
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_an_untidy_sheet_is_written_by_many_tasks_and_its_header_still_comes_first(spark, tmp_path, monkeypatch):
    folder = order_tables(spark, tmp_path)
    monkeypatch.setattr(entry, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    got = entry.queries()["dirty_sheet"](spark, folder)
    assert len(list((tmp_path / "untidy").rglob("*.csv"))) > 4
    assert got.columns[:3] == ["date", "account", "transaction_type"]
    # Every tenth key has no date; blank rows go.
    assert got.count() == sum(1 for k in range(160) if k % 10 and k % 17)
    assert got.filter("account = 'ACCOUNT 0'").count() == sum(
        1 for k in range(160) if k % 10 and k % 17 and k % 3 == 0 and k % 5 == 0
    )


def test_a_large_partition_is_exported_in_several_files_that_keep_its_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sheets, "FILE_ROWS", 10)
    data = [(str(25 - i), "x") for i in range(25)]
    write_sheet(spark.createDataFrame(data, "k string, v string").coalesce(1), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 3
    assert [r[0] for r in rows(read_sheet(spark, str(tmp_path / "out")), "_row_idx")] == [k for k, _ in data]
