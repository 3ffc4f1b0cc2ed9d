"""Reading mixed files and writing deliverables."""

import csv
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparktidy import parse_pl_number, read_csv_smart, read_grid_smart, standardize_columns, write_locale_csv
from sparktidy.operators.numbering import number_rows
from sparktidy.sinks.bundle import delivered_order, read_report, write_report
from sparktidy.sinks.locale_csv import read_locale_csv
from sparktidy.sources.delimited import append_tables, header_names, read_csv_files
from sparktidy.sources.profile import profile_files, raw_lines
from sparktidy.sources.totals import extract_control_totals


@pytest.fixture
def folder(tmp_path):
    files = {
        "utf8.csv": "order_id,sku,unit_price\nW/1,KAW-001,\"1,50\"\nW/2,N/A,29.00\n".encode(),
        "bom.csv": "﻿order_id;sku;unit_price\nB/1;Łódź;1 234,50 zł\n".encode(),
        "cp1250.csv": "Kod produktu;Cena jedn.;Miejscowość\nkaw001;1\xa0234,50 zł;Łódź\nkaw2;5,00 zł;Kraków\n".encode("cp1250"),
        "latin2.csv": "sku\tcena\tźródło\nher1\t7,00\tświęta \x88\n".encode("iso8859_2"),
        "none.csv": b"sku\nA1\n",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_profile(spark, folder):
    found = {r.file.rsplit("/", 1)[1]: (r.encoding, r.separator, r.lines, r.fields) for r in profile_files(raw_lines(spark, str(folder))).collect()}
    assert found == {
        "utf8.csv": ("utf-8", ",", 3, 3), "bom.csv": ("utf-8", ";", 2, 3), "cp1250.csv": ("windows-1250", ";", 3, 3),
        "latin2.csv": ("iso-8859-2", "\t", 2, 3), "none.csv": ("utf-8", ",", 2, 1)}


def test_utf8_line_with_bytes_foreign_to_windows_1250_in_a_broken_file(spark, tmp_path):
    # the L-stroke is C5 81 in UTF-8; 81 is no windows-1250 character, and the other line is no UTF-8
    (tmp_path / "x.csv").write_bytes(b"a;b\n\xc5\x81;1\n\xb3;2\n")
    assert profile_files(raw_lines(spark, str(tmp_path))).first().encoding == "iso-8859-2"


def test_mixed_csv(spark, folder):
    tables, profile = read_csv_smart(spark, str(folder))
    assert len(tables) == 5 and profile.count() == 5
    by_columns = {tuple(t.columns[:-1]): [tuple(r)[:-1] for r in t.collect()] for t in tables}
    assert by_columns[("order_id", "sku", "unit_price")] in (
        [("W/1", "KAW-001", "1,50"), ("W/2", None, "29.00")], [("B/1", "Łódź", "1 234,50 zł")])
    assert by_columns[("Kod produktu", "Cena jedn.", "Miejscowość")] == [("kaw001", "1\xa0234,50 zł", "Łódź"), ("kaw2", "5,00 zł", "Kraków")]
    assert by_columns[("sku", "cena", "źródło")] == [("her1", "7,00", "święta \x88")]


def test_files_of_one_format_are_read_together(spark, tmp_path):
    for i, head in enumerate(["sku,cena", "sku,cena", "cena,sku"]):
        (tmp_path / f"{i}.csv").write_text(f"{head}\nx{i},y{i}\n")
    tables, _ = read_csv_smart(spark, str(tmp_path))
    assert len(tables) == 2
    rows = append_tables([standardize_columns(t, {"sku": [], "cena": []}) for t in tables])
    assert sorted((r.sku, r.cena) for r in rows.collect()) == [("x0", "y0"), ("x1", "y1"), ("y2", "x2")]
    assert rows.select("row_id").distinct().count() == 3


def test_header_names():
    assert header_names("id;telefon1;telefon2", ";") == ["id", "telefon1", "telefon2"]
    assert header_names("Data;data;x;x;x.1;;", ";") == ["Data", "data", "x", "x.1", "x.1.1", "_c5", "_c6"]
    assert header_names('"a;b";" c ";"say ""hi"""', ";", ["file"]) == ["a;b", " c ", 'say "hi"']
    assert header_names("file,file", ",", ["file"]) == ["file.1", "file.2"] and header_names("", ",") == []


def torn(rows):
    """Cells as records, all quoted that need it, with line ends and quotes inside."""
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n").writerows(rows)
    return out.getvalue()


def test_records_over_several_lines_and_splits(spark, tmp_path):
    rng = random.Random(5)
    pieces = ["a", "b;c", 'q"', "\n", "\n\n", " ", '""', "żółw", "5\" rura", "x" * 40]
    cells = [[str(i), "".join(rng.choices(pieces, k=rng.randrange(5))), "".join(rng.choices(pieces, k=rng.randrange(3)))] for i in range(300)]
    (tmp_path / "torn.csv").write_text(torn([["id", "two\nlines", "z"], *cells]), encoding="utf-8")
    (tmp_path / "plain.csv").write_text("id;z\n1;5\" rura\n2;6\" rura\n3;x\n", encoding="utf-8")
    (tmp_path / "stray.csv").write_text('id;s\n1;"never closed\n2;b\n3;c\n', encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        files = read_csv_files(spark, str(tmp_path))
        (table,) = [t for t in files.tables if "two\nlines" in t.columns]
        assert table.select("id", "two\nlines", "z").rdd.getNumPartitions() > 1
        got = {r[0]: (r[1], r[2]) for r in table.select("id", "`two\nlines`", "z").collect()}
        assert got == {i: tuple(c or None for c in (a, b)) for i, a, b in cells}
        ids = [r[0] for t in files.tables for r in t.select("row_id").collect()]
        assert len(set(ids)) == len(ids) == 300 + 3 + 3
        by_number = [int(r[0]) for r in table.orderBy("row_id").collect()]
        assert by_number == sorted(by_number)
        (plain,) = [t for t in files.tables if t.columns[:2] == ["id", "z"]]
        assert sorted(tuple(r)[:2] for r in plain.collect()) == [("1", '5" rura'), ("2", '6" rura'), ("3", "x")]
        (stray,) = [t for t in files.tables if t.columns[:2] == ["id", "s"]]
        assert sorted(r[0] for r in stray.collect()) == ["1", "2", "3"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b;c\n1;2;3;LOST\n4;5\n\n6;"7;7";8\n9;10;\n"x;y";"z\n', encoding="utf-8")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_text("a;b;c\n", encoding="utf-8")
    files = read_csv_files(spark, str(tmp_path))
    (table,) = files.tables
    assert sorted(map(tuple, table.select("a", "b", "c").collect()))[:3] == [("4", "5", None), ("6", "7;7", "8"), ("9", "10", None)]
    got = sorted((r.record, r.cells, r["columns"], r.reason, r.kept) for r in files.rejects.collect())
    assert ("1;2;3;LOST", 4, 3, "surplus", False) in got and ("4;5", 2, 3, "short", True) in got and len(got) == 3
    strict = read_csv_files(spark, str(tmp_path), keep_short=False)
    assert sorted(map(tuple, strict.tables[0].select("a", "b", "c").collect())) == [("6", "7;7", "8"), ("9", "10", None)]
    profile = {r.file.rsplit("/", 1)[1]: (r.lines, r.separator) for r in files.profile.collect()}
    assert profile == {"a.csv": (7, ";"), "empty.csv": (0, None), "head.csv": (1, ";")}


def test_dense_row_numbers(spark):
    rows = [(("hot" if i % 3 else f"k{i % 7}") if i % 50 else None, (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, v int")
    whole = [r.n for r in number_rows(df, [F.col("v")], "n").orderBy("v").collect()]
    assert whole == list(range(1, 1001))
    by_key = defaultdict(list)
    for r in number_rows(df, [F.col("v").desc()], "n", 0, ["k"]).collect():
        by_key[r.k].append((-r.v, r.n))
    assert sum(map(len, by_key.values())) == 1000
    for own in by_key.values():
        assert [n for _, n in sorted(own)] == list(range(len(own)))
    assert number_rows(df.limit(0), [F.col("v")], "n", 0, ["k"]).count() == 0


def test_grid(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Raport;;;\n;;;\n Nr paragonu ;SKU;Szt.;\nG-1;KAW 001;2;\n;;;\nG-2;;1;\nG-3;A;1;x\n", encoding="utf-8")
    (tmp_path / "h.csv").write_text("Nr;SKU\n1;2\n", encoding="utf-8")
    tables = read_grid_smart(spark, str(tmp_path))
    got = {tuple(t.columns[:-2]): sorted((tuple(r)[:-2] for r in t.collect()), key=str) for t in tables}
    # the widest filled row is the last one here, as it has four cells; the file's own rule decides
    assert got[("Nr", "SKU")] == [("1", "2")]
    assert ("G-3", "A", "1", "x") in got


def test_grid_with_titles(spark, tmp_path):
    (tmp_path / "g.csv").write_bytes("Raport sprzedaży;;\n;;\n Nr paragonu ;SKU;Ilość\nG-1;KAW 001;2\n;;\nG-2;;1\n".encode("cp1250"))
    (table,) = read_grid_smart(spark, str(tmp_path))
    assert table.columns[:3] == ["Nr paragonu", "SKU", "Ilość"]
    assert [tuple(r)[:3] for r in table.orderBy("row_no").collect()] == [("G-1", "KAW 001", "2"), ("G-2", None, "1")]


def test_grid_keeps_columns_without_a_name(spark, tmp_path):
    (tmp_path / "g.csv").write_text('Raport;;;;\n;;;;\nNr;SKU;;Cena;\n1;A;;2;\n2;;"uwaga\ni opis";3;\n;;;;\n', encoding="utf-8")
    (tmp_path / "h.csv").write_text("Nr;SKU;;Cena;\n3;C;;4;\n", encoding="utf-8")
    (table,) = read_grid_smart(spark, str(tmp_path))
    assert table.columns == ["Nr", "SKU", "_c2", "Cena", "source_file", "row_no"]
    assert [tuple(r)[:4] for r in table.orderBy("row_no").collect()] == [("1", "A", None, "2"), ("2", None, "uwaga\ni opis", "3"), ("3", "C", None, "4")]


def test_control_totals(spark):
    df = spark.createDataFrame(
        [(1, "K", "2024-01-01", "5,00 zł"), (2, "K", " razem ", "1 234,50 zł"), (3, "K", "SUMA", "9"), (4, "L", "x", "1"), (5, "M", "Total", "?"), (6, "M", None, "2")],
        "row_id long, branch string, `Data` string, `Wartość` string")
    data, controls = extract_control_totals(df, "Data", "Wartość", "row_id", "branch")
    assert sorted(r.row_id for r in data.collect()) == [1, 4, 6]
    assert {r.branch: (str(r.suma_z_pliku), r.total_rows) for r in controls.collect()} == {"K": ("1234.50", 2), "M": ("None", 1)}


def test_locale_csv(spark, tmp_path):
    df = spark.createDataFrame([("2024-03-05", 1234.5, "a;\"b\"", 1e10, None), ("2024-03-06", 0.1, None, 2.0, 3)], "d string, m double, t string, f double, n int")
    df = df.select(F.col("d").cast("date").alias("d"), F.col("m").cast("decimal(18,2)").alias("m"), "t", "f", "n")
    path = str(tmp_path / "out")
    write_locale_csv(df.coalesce(1), path)
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfd;m;t;f;n")
    text = part.read_text(encoding="utf-8-sig").splitlines()
    assert text[1:] == ['2024-03-05;1234,50;"a;""b""";10000000000,0;', "2024-03-06;0,10;;2,0;3"]
    back = read_locale_csv(spark, path)
    assert back.columns == df.columns
    assert [r[0] for r in back.select(parse_pl_number("m")).collect()] == [1234.5, 0.1]


def test_report_bundle(spark, tmp_path):
    path = str(tmp_path / "report")
    manifest = write_report({"x": spark.range(5), "y": spark.range(0).selectExpr("id", "id as other")}, path)
    assert sorted(map(tuple, manifest.collect())) == [("x", 5, 1), ("y", 0, 2)]
    tables = read_report(spark, path)
    assert {n: t.count() for n, t in tables.items()} == {"x": 5, "y": 0}


def test_order_is_proven_by_the_parts(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 97 as k", "id as v").withColumn("n", F.when(F.col("v") % 5 > 0, F.col("v")))
    tables = {"sorted": rows.repartition(6).orderBy("k", "n"), "mixed": rows.repartition(3), "parts_only": rows.repartition(3, "k").sortWithinPartitions("k")}
    write_report(tables, str(tmp_path / "r"), {"sorted": ["k", "n"], "mixed": ["k"], "parts_only": ["k"]})
    got = {r.name: (r.rows, r.in_order) for r in delivered_order(spark, str(tmp_path / "r")).collect()}
    assert got == {"sorted": (1000, True), "mixed": (1000, False), "parts_only": (1000, False)}
    parts = spark.read.parquet(str(tmp_path / "r" / "parts")).filter("name = 'sorted'")
    assert parts.filter("least like '{\"k\":0%'").count() >= 1 and parts.agg(F.sum("rows")).first()[0] == 1000


def test_floats_keep_their_shortest_digits(spark, tmp_path):
    values = [1e30, 1.23e-12, 0.00012345678901234, 3.66e22, -5e-300, 1.7976931348623157e308, 0.1 + 0.2, 1e15, -0.0, 123456789.125, 9007199254740993.0]
    write_locale_csv(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double"), str(tmp_path / "f"))
    for i, text in ((int(r.i), r.v) for r in read_locale_csv(spark, str(tmp_path / "f")).collect()):
        assert "E" not in text and float(text.replace(",", ".")) == values[i]
        assert len(text.replace(",", "").replace("-", "").strip("0")) <= len(repr(values[i]).split("e")[0].replace(".", "").replace("-", "").strip("0"))


def test_file_names_with_spaces_brackets_and_percent_signs(spark, tmp_path):
    for name in ("sprzedaz maj.csv", "maj[1].csv", "rabat%20.csv"):
        (tmp_path / name).write_text("a;b\n1;2\n", encoding="utf-8")
    tables, _ = read_csv_smart(spark, str(tmp_path))
    assert sum(t.count() for t in tables) == 3
    assert sum(t.count() for t in read_grid_smart(spark, str(tmp_path))) == 3


def test_locale_csv_keeps_spaces_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, " KAW-1 "), (2, "two\nlines")], "i int, t string")
    write_locale_csv(df, str(tmp_path / "out"))
    assert sorted(r[1] for r in read_locale_csv(spark, str(tmp_path / "out")).collect()) == [" KAW-1 ", "two\nlines"]


def test_records_meet_only_the_parser_of_their_format(spark, tmp_path):
    """No filter holds the parser: it would be moved below the join with the files, to the records of all formats."""
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("x;y\n4;5\n6\n7;8;9\n", encoding="utf-8")
    files = read_csv_files(spark, str(tmp_path))
    assert sorted((r.x, r.y) for t in files.tables for r in t.collect()) == [("1", "2"), ("3", None), ("4", "5"), ("6", None)]
    grids = read_grid_smart(spark, str(tmp_path))
    for table in [*files.tables, files.rejects, *grids]:
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "from_csv" in plan
        assert not [line for line in plan.splitlines() if "Filter" in line and "from_csv" in line]


def test_profile_keeps_no_lines_for_a_header(spark, tmp_path):
    """Lines are not sorted by file, also if only the separator is asked for."""
    from sparktidy.sources.profile import profile_files, raw_lines

    (tmp_path / "a.csv").write_text("\n  \na;b;c\n1;2;3\n")
    (tmp_path / "b.csv").write_text("x,y\n" * 50)
    found = profile_files(raw_lines(spark, str(tmp_path))).select("separator", "fields", "header")
    assert sorted(map(tuple, found.collect())) == [(",", 2, "x,y"), (";", 3, "a;b;c")]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "c.csv").write_text("  \n\n")
    assert sorted(map(str, (r.header for r in profile_files(raw_lines(spark, str(tmp_path))).collect()))) == ["None", "a;b;c", "x,y"]
