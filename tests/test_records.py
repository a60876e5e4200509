import csv
import io
import random

import pandas as pd
import pytest

from patronlens.sources import records, transactions

COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


def messy_cell(rng):
    return "".join(rng.choice(['"', ",", "\n", "\r\n", "a", " ", "é", '""', "x y", "\\", "'"]) for _ in range(rng.randrange(6))) or "z"


def rows_of(rng, n):
    return [
        (f"5{i}", f"S{i}", messy_cell(rng) + str(i), rng.randrange(1, 9), "2010-12-01 08:26:00", i + 0.5, f"{17000 + i}", messy_cell(rng))
        for i in range(n)
    ]


def read(spark, path, splits=None):
    if splits:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(splits))
    try:
        found = transactions.load_transactions(spark, path, format="csv")
        got = sorted(tuple(r) for r in found.select("InvoiceNo", "StockCode", "Description", "Quantity", "CustomerID", "Country").collect())
        return got
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def wanted(rows):
    return sorted((r[0], r[1], r[2], r[3], r[6], r[7]) for r in rows)


@pytest.mark.parametrize("splits", [None, 300, 5000])
def test_files_written_by_pandas_come_back_cell_for_cell(spark, tmp_path, splits):
    rows = rows_of(random.Random(splits), 150)
    path = tmp_path / "all.csv"
    pd.DataFrame(rows, columns=COLUMNS).to_csv(path, index=False, encoding="latin-1", lineterminator="\r\n" if splits == 300 else "\n")
    assert records.has_long_records(spark, str(path), "ISO-8859-1")
    assert read(spark, str(path), splits) == wanted(rows)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = rows_of(random.Random(1), 1000)
    path = tmp_path / "all.csv"
    pd.DataFrame(rows, columns=COLUMNS).to_csv(path, index=False, encoding="latin-1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = records._lines(spark, str(path), "ISO-8859-1")
        assert lines.select("chunk").distinct().count() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_record_over_many_chunks(spark, tmp_path):
    rows = rows_of(random.Random(2), 5)
    long = [*rows[2]]
    long[2] = 'said ""twice"",\n' * 200
    rows[2] = tuple(long)
    path = tmp_path / "all.csv"
    pd.DataFrame(rows, columns=COLUMNS).to_csv(path, index=False, encoding="latin-1")
    assert read(spark, str(path), 400) == wanted(rows)


def test_quotes_without_line_breaks(spark, tmp_path):
    """The file of quoted commas and doubled quotes that shifted columns before."""
    path = tmp_path / "all.csv"
    path.write_text(",".join(COLUMNS) + '\n1,A,"SET OF 3 ""PINK"", HEARTS",2,2010-12-01 08:26:00,1.5,17850.0,France\n2,B,5" PIPE,1,2010-12-01 08:26:00,1.5,1,"UK"\n')
    assert not records.has_long_records(spark, str(path), "ISO-8859-1")
    assert read(spark, str(path)) == [("1", "A", 'SET OF 3 "PINK", HEARTS', 2, "17850.0", "France"), ("2", "B", '5" PIPE', 1, "1", "UK")]
    assert transactions.unreadable_cells(spark, str(path)).filter("unreadable > 0").isEmpty()


def test_round_trip(spark, tmp_path):
    rows = [r for r in rows_of(random.Random(3), 300)]
    rows += [("900", "T", "  blanks at both ends  ", 1, "2010-12-01 08:26:00", 1.5, "1", "\\")]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=COLUMNS)).repartition(3)
    path = str(tmp_path / "out")
    transactions.write_transactions(df, path)
    assert read(spark, path) == wanted(rows)
    files = [f for f in (tmp_path / "out").iterdir() if f.name.endswith(".csv")]
    back = pd.concat(pd.read_csv(f, encoding="latin-1", dtype=str, lineterminator=None) for f in files)
    assert sorted(back["InvoiceNo"]) == sorted(r[0] for r in rows)


def test_stray_quotes_count_as_the_csv_module_counts_them(spark, tmp_path):
    rng = random.Random(7)
    for _ in range(6):
        text = "a,b\n" + "".join(rng.choice(['"', ",", "\n", "x", '"y"', ' "', '\n"']) for _ in range(400)) + "x"
        path = tmp_path / f"{rng.random()}.csv"
        path.write_text(text)
        want = [["" if c is None else c for c in (r + [""])[:2]] for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
        got = records.long_record_rows(spark, str(path), "ISO-8859-1").select("a", "b").collect()
        assert sorted([r.a or "", r.b or ""] for r in got) == sorted(w for w in want)


def test_headers_and_empty_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,"b\nc"\n1,2\n')
    got = records.long_record_rows(spark, str(tmp_path / "one.csv"), "ISO-8859-1")
    assert got.columns == ["a", "b\nc"] and [tuple(r) for r in got.collect()] == [("1", "2")]
    (tmp_path / "two.csv").write_text("a,x\n1,2\n")
    with pytest.raises(ValueError, match="headers"):
        records.long_record_rows(spark, str(tmp_path), "ISO-8859-1")
    (tmp_path / "none.csv").write_text("")
    assert records.records(spark, str(tmp_path / "none.csv"), "ISO-8859-1").collect() == []
