"""Sources: decimal comma, lenient coercion, file-name dates, delimited and workbook round trips."""

import datetime as dt
import decimal
import os

from helpers import rows
from pyspark.sql import functions as F

from daybook.functions.coerce import coerce_by_name, lenient_amount
from daybook.functions.filenames import batch_date_from_name
from daybook.schemas import TERMINALS, TRANSACTIONS
from daybook.sources.delimited import read_feed, write_delimited
from daybook.sources.workbook import parse_first_sheet, read_workbooks, write_minimal_xlsx


def test_amount_with_decimal_comma(spark):
    df = spark.createDataFrame([("1234,56",), ("abc",), ("7,005",), ("",), (None,), ("123456789012,5",)], "a string")
    got = [r[0] for r in df.select(lenient_amount(F.col("a"))).collect()]
    assert got == [decimal.Decimal("1234.56"), None, decimal.Decimal("7.01"), None, None, None]


def test_name_driven_coercion(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00", "1,5", "x"), ("junk", "?", "y")], "Trans_Date string, amount string, other string")
    out = coerce_by_name(df)
    assert dict(out.dtypes) == {"Trans_Date": "timestamp_ntz", "amount": "decimal(10,2)", "other": "string"}
    assert rows(out) == sorted(
        [(dt.datetime(2024, 1, 5, 10), decimal.Decimal("1.50"), "x"), (None, None, "y")], key=repr
    )


def test_batch_date_from_file_name(spark):
    names = ["transactions_01032021.txt", "terminals_31022024.xlsx", "passport_blacklist.xlsx", "x_1032021.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(batch_date_from_name(F.col("n"))).collect()]
    assert got == [dt.date(2021, 3, 1), None, None, None]


def test_delimited_round_trip_keeps_leading_zeros(spark, tmpdir_path):
    data = [(1, dt.datetime(2024, 1, 1, 9, 0, 0), decimal.Decimal("1234.56"), "0042 0000 1111 2222", "pay", "OK", "007")]
    df = spark.createDataFrame(data, TRANSACTIONS)
    path = os.path.join(tmpdir_path, "transactions_01012024.txt")
    write_delimited(df, path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert "1234,56" in text and ";" in text
    back = read_feed(spark, path, TRANSACTIONS, with_batch_date=False)
    assert rows(back) == rows(df)


def test_workbook_reader(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "in")
    os.makedirs(folder)
    write_minimal_xlsx(
        os.path.join(folder, "terminals_01012024.xlsx"),
        ["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
        [["A001", "ATM", "Moscow", "Lenina 1"], ["A002", "POS", None, "Mira & 2"]],
    )
    write_minimal_xlsx(os.path.join(folder, "other.xlsx"), ["x"], [[1]])
    header, body = parse_first_sheet(open(os.path.join(folder, "terminals_01012024.xlsx"), "rb").read())
    assert header[0] == "terminal_id" and body[1][2] is None
    df = read_workbooks(spark, folder, TERMINALS, glob="*terminals*.xlsx")
    assert rows(df) == [("A001", "ATM", "Moscow", "Lenina 1"), ("A002", "POS", None, "Mira & 2")]


def test_workbook_numbers_and_dates(spark, tmpdir_path):
    # A cell styled as a date holds a serial day number.
    import zipfile

    path = os.path.join(tmpdir_path, "passport_blacklist_01012024.xlsx")
    write_minimal_xlsx(path, ["date", "passport"], [[45292, "0001 123456"]])
    with zipfile.ZipFile(path, "a") as z:
        z.writestr(
            "xl/styles.xml",
            '<?xml version="1.0"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        sheet = z.read("xl/worksheets/sheet1.xml").decode().replace('<c r="A2">', '<c r="A2" s="1">')
    with zipfile.ZipFile(path) as zin, zipfile.ZipFile(path + ".tmp", "w") as zout:
        for item in zin.infolist():
            data = sheet.encode() if item.filename == "xl/worksheets/sheet1.xml" else zin.read(item.filename)
            zout.writestr(item.filename, data)
    header, body = parse_first_sheet(open(path + ".tmp", "rb").read())
    assert body == [["2024-01-01 00:00:00", "0001 123456"]]
