"""Both jobs end to end on small hand-checked inputs, plus plan and streaming checks."""

import re

import pytest
from pyspark.sql import functions as F

from sparktidy import apply_rules, normalize_email, normalize_phone_pl, parse_mixed_dates, parse_pl_number
from sparktidy.plans import crm, sales
from sparktidy.sources.totals import extract_control_totals

EXPORT = [
    # id, name, e-mail, phone, city, code, date, amount
    ("K1", "  pani ANNA   nowak ", "anna@gmial.com", "500-100-200", "W-wa", "950", "05.03.24", "1 234,50 zł"),
    ("K2", "Anna Nowak", "ANNAgmail.com", "+48 500 100 200", "Warszawa", "00-950", "2023-01-01", "10"),
    ("K3", "anna nowak", "brak", "0048500100200", "warszawa", "30-001", "31.02.2023", "PLN 5.00"),
    ("K4", "Anna Nowak", None, "12345", "Kraków", "30001", "45356", "brak"),
    ("K5", "Jan Żak", " JAN@o2,pl ", None, "zakopane", "x", "2024-01-05 00:00:00", "1.000,00"),
    ("K5", "Jan Żak", " JAN@o2,pl ", None, "zakopane", "x", "2024-01-05 00:00:00", "1.000,00"),
    ("", " - ", "brak", None, None, "", "n/a", "?"),
    (None, None, None, None, None, None, None, None),
    ("K6", "Ewa Mazur", "jan@o2.pl", "(48) 600700800", "LODZ", "90-100", "1/2/2022", "1,5"),
]
HEADER = "row_id long, `ID klienta` string, ` Imię i nazwisko ` string, `E-MAIL` string, `tel.` string, `Miasto` string, `Kod poczt.` string, `Data rej.` string, `Wartość zamówień (PLN)` string"


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(i, *r) for i, r in enumerate(EXPORT)]
    return crm.clean_customers(spark.createDataFrame(rows, HEADER).repartition(3))


def test_golden_customers(customers):
    got = {r.id_klienta: r for r in customers.customers.collect()}
    assert set(got) == {"K2", "K4", "K6"}
    anna = got["K2"]  # earliest date first, values filled from later rows
    assert (anna.imie, anna.nazwisko, anna.email, anna.telefon, anna.miasto, anna.kod_pocztowy) == (
        "Anna", "Nowak", "anna@gmail.com", "+48 500 100 200", "Warszawa", "00-950")
    assert (str(anna.data_rejestracji), str(anna.wartosc_zamowien_pln), anna.liczba_rekordow, anna.scalone_id) == ("2023-01-01", "1249.50", 3, "K1, K2, K3")
    assert anna.do_sprawdzenia == ""
    assert got["K4"].do_sprawdzenia == "brak: e-mail; nieprawidłowy telefon: '12345'"
    assert got["K4"].wartosc_zamowien_pln is None  # a name alone never links
    assert got["K6"].scalone_id == "K5, K6" and got["K6"].kod_pocztowy == "90-100" and got["K6"].do_sprawdzenia == ""


def test_customer_log_balances(customers):
    log = {r.step_no: r["count"] for r in customers.log.collect()}
    assert [log[i] for i in (1, 2, 3, 11, 12, 13)] == [9, 2, 1, 3, 3, 1]
    assert log[1] - log[2] - log[3] - log[11] == log[12]
    stats = customers.headline.first()
    assert (stats.rows_in, stats.customers, stats.merged, stats.to_verify) == (9, 3, 3, 1)
    assert stats.standardized == sum(log[i] for i in range(4, 11))


def test_customer_report_tables(customers):
    tables = customers.report_tables()
    assert {n: t.count() for n, t in tables.items()} == {"klienci": 3, "scalone_duplikaty": 2, "do_weryfikacji": 1, "log_zmian": 13}
    assert "scalone_id" not in tables["klienci"].columns
    lists = {r.group_id: r.record_ids for r in customers.merged_id_lists.collect()}
    assert sorted(lists.values()) == ["K1, K2, K3", "K5, K6"]


def test_repaired_rows_need_every_field(customers):
    rows = customers.repaired(9).collect()
    assert rows[0].id_klienta == "K1" and rows[0].score == 7 and rows[0].changed_wartosc_zamowien_pln
    assert {r.id_klienta: r.score for r in rows}["K4"] == -1
    plain = {r.id_klienta: r for r in rows}["K2"]
    assert plain.score == -1 and not plain.changed_wartosc_zamowien_pln  # '10' and 10.00 are the same amount


@pytest.fixture(scope="module")
def merged(spark):
    a = spark.createDataFrame(
        [(0, "A/1", "2025-01-02", "KAW-001", "2", "10.00"), (1, "A/2", "2025-01-03", "her 2", "1", "9.00"), (2, "A/1", "2025-01-02", "kaw1", "2", "10.00"),
         (3, "A/3", "2025-02-01", None, "1", "4"), (4, "A/4", "2025-02-01", "KAW001", "1.5", "4"), (5, "A/5", "kiedyś", "KAW001", "?", "4")],
        "row_id long, order_id string, order_date string, sku string, quantity string, unit_price string")
    b = spark.createDataFrame(
        [(10, "05.01.2025", "kaw001", "3", "10,00 zł", "30,00 zł"), (11, "05.01.2025", "kaw001", "3", "10,00 zł", "30,00 zł"), (12, "07.03.2025", "ZZZ-9", "1", "1 234,50 zł", "1 234,50 zł"),
         (13, "RAZEM", None, None, None, "1 294,50 zł")],
        "row_id long, `Data` string, `Kod produktu` string, `Ilość` string, `Cena jedn.` string, `Wartość` string")
    frames, controls = [], None
    for name, df, first, last in [("A", a, "order_id", "unit_price"), ("B", b, "Data", "Wartość")]:
        data, control = extract_control_totals(df.withColumn("oddzial", F.lit(name)), first, last, "row_id", "oddzial")
        frames.append(data)
        controls = control if controls is None else controls.unionByName(control)
    catalog = spark.createDataFrame([("kaw 1", "Kawa", "Napoje", "10,00"), ("HER-002", "Herbata", "Napoje", "10,00 zł")], "`SKU` string, `Nazwa produktu` string, `Kategoria` string, `Cena katalogowa` string")
    return sales.merge_sales(sales.merge_branches(frames, "row_id"), sales.typed_catalog(catalog), controls)


def test_merged_sales(merged):
    rows = {r.row_id: r for r in merged.sales.collect()}
    assert set(rows) == {0, 1, 3, 10, 11, 12}
    assert (rows[1].sku, rows[1].nazwa_produktu, rows[1].rabat, str(rows[1].wartosc_brutto), rows[1].miesiac) == ("HER-002", "Herbata", "tak", "9.00", "2025-01")
    assert (rows[12].kategoria, rows[12].rabat, str(rows[12].wartosc_brutto)) == ("Brak w katalogu", "nie", "1234.50")
    assert rows[10].nr_transakcji is None
    assert merged.final.columns == list(sales.MERGED)


def test_nothing_disappears(merged):
    assert [r.sku for r in merged.repeats.collect()] == ["KAW-001"]
    assert sorted(r.reason for r in merged.rejects.collect()) == ["data, ilosc", "ilosc"]
    log = {r.step: r["count"] for r in merged.log.collect()}
    loaded = sum(n for step, n in log.items() if "wczytane transakcje" in step)
    assert loaded == log["Transakcje w pliku wynikowym"] + 1 + 2 == 9
    assert log["A: ujednolicone kody SKU"] == 4 and log["B: ujednolicone kody SKU"] == 3 and log["B: usunięty wiersz podsumowania (RAZEM)"] == 1


def test_sales_summaries(merged):
    assert {r.miesiac: (r.A and str(r.A), r.B and str(r.B), str(r.RAZEM)) for r in merged.by_month.collect()} == {
        "2025-01": ("29.00", "60.00", "89.00"), "2025-02": ("4.00", None, "4.00"), "2025-03": (None, "1234.50", "1234.50"), "RAZEM": ("33.00", "1294.50", "1327.50")}
    assert [tuple(map(str, r)) for r in merged.checks.collect()] == [("B", "1294.50", "1294.50", "0.00", "0.00", "TAK")]
    assert [(r.oddzial, r.sku, r.transakcje) for r in merged.unmatched.orderBy("oddzial").collect()] == [("A", None, 1), ("B", "ZZZ-009", 1)]
    top = merged.top_products(2).collect()
    assert [(r.sku, r.sprzedane_szt, str(r.przychod)) for r in top] == [("ZZZ-009", 1, "1234.50"), ("KAW-001", 8, "80.00")]
    assert str(merged.control_difference.first()[0]) == "0.00"
    assert [(r.oddzial, r.row_id) for r in merged.sample({}).orderBy("oddzial").collect()] == [("A", 1), ("B", 10)]


def plan_text(df):
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_rows_never_leave_the_jvm(merged, customers):
    for table in [*merged.report_tables().values(), *customers.report_tables().values()]:
        assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct", plan_text(table))


def test_status_filters_reach_the_scan(merged):
    plan = plan_text(merged.unmatched)
    assert "EqualTo(reason,)" in plan
    assert "ReadSchema: struct<oddzial:string,sku:string,is_repeat:boolean,reason:string,w_katalogu:boolean,wartosc_brutto:decimal(18,2)>" in plan


def test_summaries_take_few_columns_through_a_large_catalog(spark, monkeypatch, merged):
    """A catalog that is not broadcast: the same results, and only what summaries read is shuffled or staged for them."""
    from sparktidy.operators import enrich

    lookup = enrich.null_safe_lookup
    monkeypatch.setattr(sales, "null_safe_lookup", lambda *a, **k: lookup(*a, max_broadcast_bytes=0, **k))
    typed = spark.createDataFrame(
        [(i, "AB"[i % 2], None if i % 3 else f"D{i % 12}", f"kaw {i % 5}", f"2025-0{i % 4 + 1}-03", "?" if i % 7 == 0 else "2", "10,50 zł") for i in range(60)],
        "row_id long, oddzial string, nr_transakcji string, sku string, data string, ilosc string, cena_jedn string")
    catalog = spark.createDataFrame([(f"KAW-00{i}", f"Kawa {i}", "Napoje" if i else None, 10.0) for i in range(3)], "sku string, nazwa_produktu string, kategoria string, cena_katalogowa double")
    controls = spark.createDataFrame([("A", "100.00", 1)], "oddzial string, suma_z_pliku string, total_rows long")
    controls = controls.withColumn("suma_z_pliku", F.col("suma_z_pliku").cast("decimal(18,2)"))

    def merge():
        return sales.merge_sales(sales.typed_sales(typed, "row_id"), catalog, controls)

    def rows(df):
        return sorted(map(str, df.collect()))

    few, every = merge(), merge()
    assert every.every.count() == 60
    assert few.amounts.columns == list(sales.SUMMED)
    for name in ("by_month", "by_category", "monthly", "unmatched", "checks", "log", "headline"):
        assert rows(getattr(few, name)) == rows(getattr(every, name))
    assert every.amounts is every.every
    assert rows(few.final) == rows(every.final)
    assert "every" not in few.__dict__  # the merged table is computed where it is written
    shuffled = [line for line in re.findall(r"Exchange\nInput \[\d+\]: (.*)", plan_text(few.final)) if "cena_jedn" in line]
    assert shuffled and not re.search("row_id|sku_raw|sku_fixed|is_repeat", " ".join(shuffled))
    told = re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: rangepart", plan_text(every.report_tables()["dane"]))
    assert len(told) == 1 and not re.search("miesiac|rabat|wartosc", told[0])
    keys = [(r.data, r.oddzial) for r in every.report_tables()["dane"].collect()]
    assert keys == sorted(keys) and rows(every.report_tables()["dane"]) == rows(every.final)
    # the small catalog of the other tests: rows of all outputs agree too
    assert rows(merged.final) == rows(merged.sales.select(*sales.MERGED))


def test_rules_run_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a@gmial.com;123456789;05.03.24;1,50\nbrak;1;x;y\n")
    stream = spark.readStream.schema("m string, t string, d string, n string").csv(str(tmp_path / "in"), sep=";")
    clean = apply_rules(stream, {"m": (normalize_email, "m"), "t": (normalize_phone_pl, "t"), "d": (parse_mixed_dates, "d"), "n": (parse_pl_number, "n")})
    query = clean.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "ck")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted((tuple(map(str, r)) for r in spark.table("cleaned").collect()), reverse=True) == [
        ("a@gmail.com", "+48 123 456 789", "2024-03-05", "1.5"), ("None", "None", "None", "None")]


def test_shared_folder_comes_from_the_session(spark):
    from sparktidy import workspace

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert workspace.shared_dir(spark) == named.rstrip("/")
    assert workspace.scratch_path(spark, "x") != workspace.scratch_path(spark, "x")


def test_exports_take_their_totals_from_the_written_rows(spark):
    from verification import fixtures, queries

    sf_dir = "/root/testdata/sf0.001"
    got, want = queries.exports(spark, sf_dir), queries.fixture(spark, sf_dir, fixtures.EXPORTS)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert not [f for f in got.inputFiles() if "lineitem" in f]
