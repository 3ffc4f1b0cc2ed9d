"""One Spark query per operator, over the provided tables or messy tables derived from them.

Results are made of strings, 64-bit integers, doubles and booleans only, so that both engines
report the same types.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions import numbers
from sparktidy.functions.codes import normalize_sku
from sparktidy.functions.contact import normalize_email, normalize_phone_pl, normalize_postal_code_pl
from sparktidy.functions.dates import month_bucket, parse_mixed_dates
from sparktidy.functions.numbers import parse_pl_number
from sparktidy.functions.render import format_amount, format_date, plain_text
from sparktidy.functions.rule import apply_rules
from sparktidy.functions.text import (
    clean_text,
    column_key,
    mark_whitespace,
    normalize_city,
    normalize_key,
    normalize_person_name,
    split_full_name,
    strip_accents,
)
from sparktidy.operators import columns, dedup, enrich, linking, quality, summarize, survivorship
from sparktidy.plans import crm, sales
from sparktidy.session import tune
from sparktidy.sinks import bundle
from sparktidy.sinks.bundle import write_report
from sparktidy.sinks.locale_csv import read_locale_csv, write_locale_csv
from sparktidy.sources.delimited import number_rows, read_csv_files, spread_scan
from sparktidy.sources.grid import detect_header_row, read_grid_smart
from sparktidy.sources.profile import profile_files, raw_lines
from sparktidy.sources.totals import extract_control_totals
from sparktidy.workspace import scratch_path, stage
from verification import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query; it runs in a session with the engine's settings."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# ---- inputs -----------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


INPUT_KEYS = {"customer": "c_custkey", "part": "p_partkey", "documents": "doc_id", "conversations": "conv_id"}


def fixture(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    inputs = {
        name: spread_scan(table(spark, sf_dir, name), key) for name, key in INPUT_KEYS.items() if "{%s}" % name in text
    }
    if "{lineitem}" in text:
        inputs["lineitem"] = spread_scan(number_rows(table(spark, sf_dir, "lineitem")), "row_id")
    return spark.sql(text, **inputs)


def flat(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as doubles, integers as 64 bit."""
    out = []
    for name, kind in df.dtypes:
        target = "string" if kind in ("date", "timestamp") else "double" if kind.startswith("decimal") else "bigint" if kind in ("int", "smallint", "tinyint") else None
        value = F.col(f"`{name}`")
        out.append(value.cast(target).alias(name) if target else value)
    return df.select(*out)


def crm_rows(spark, sf_dir):
    return fixture(spark, sf_dir, fixtures.CRM)


def customer_tables(spark, sf_dir) -> crm.CustomerTables:
    return crm.clean_customers(fixture(spark, sf_dir, fixtures.CRM_EXPORT))


def typed_customers(spark, sf_dir) -> DataFrame:
    """Distinct, non-blank, typed customer rows."""
    return crm.typed_customers(fixture(spark, sf_dir, fixtures.CRM_EXPORT), "row_id").filter("not blank")


def sale_rows(spark, sf_dir):
    """Typed sales, staged as in the job, because several branches of a query read them."""
    return stage(sales.typed_sales(fixture(spark, sf_dir, fixtures.SALES), "row_id"), "sales-typed")


def exports(spark, sf_dir) -> DataFrame:
    """:data:`fixtures.EXPORTS`, written once; the totals are taken from the written rows."""
    sold = stage(fixture(spark, sf_dir, fixtures.SALES), "exports")
    rows, totals = (spark.sql(part.replace("({SALES})", "{sales}"), sales=sold) for part in (fixtures.SOLD, fixtures.TOTALS))
    return rows.unionAll(stage(totals.toDF(*rows.columns), "totals"))


def branch_exports(spark, sf_dir) -> list[tuple[DataFrame, str, str]]:
    """The three exports with the headers of their systems: (table, first column, last column)."""
    rows = exports(spark, sf_dir)
    a = rows.filter("oddzial = 'A'").selectExpr(
        "row_id", "oddzial", "data as `order_date`", "nr_transakcji as `order_id`", "sku", "ilosc as `quantity`",
        "cena_jedn as `unit_price`", "wartosc as `value`")
    b = rows.filter("oddzial = 'B'").selectExpr(
        "row_id", "oddzial", "data as `Data`", "sku as `Kod produktu`", "ilosc as `Ilość`", "cena_jedn as `Cena jedn.`",
        "wartosc as `Wartość`")
    c = rows.filter("oddzial = 'C'").selectExpr(
        "row_id", "oddzial", "data as `Data sprzedaży`", "nr_transakcji as `Nr paragonu`", "sku as ` SKU `", "ilosc as `Szt.`",
        "cena_jedn as `Cena brutto`", "wartosc as `Suma`")
    return [(a, "order_date", "value"), (b, "Data", "Wartość"), (c, "Data sprzedaży", "Suma")]


def split_exports(spark, sf_dir) -> tuple[list[DataFrame], DataFrame]:
    data, controls = [], None
    for export, first, last in branch_exports(spark, sf_dir):
        rows, control = extract_control_totals(export, first, last, "row_id", "oddzial")
        data.append(rows)
        controls = control if controls is None else controls.unionByName(control)
    return data, controls


def sales_tables(spark, sf_dir) -> sales.SalesTables:
    data, controls = split_exports(spark, sf_dir)
    catalog = sales.typed_catalog(fixture(spark, sf_dir, fixtures.CATALOG))
    return sales.merge_sales(sales.merge_branches(data, "row_id"), catalog, controls)


def text_rule(name, rule):
    def run(spark, sf_dir):
        texts = fixture(spark, sf_dir, fixtures.TEXTS)
        out = apply_rules(texts, {"out": (rule, "text")}, keep=["id"])
        return flat(out.select("id", F.md5("out").alias("digest"), F.length("out").alias("chars")))

    run.__name__ = name
    return query(run)


# ---- 2.2 text rules -----------------------------------------------------------------
text_rule("clean_text", clean_text)
text_rule("strip_accents", strip_accents)
text_rule("normalize_key", normalize_key)
text_rule("column_key", column_key)
text_rule("mark_whitespace", mark_whitespace)


@query
def normalize_person_names(spark, sf_dir):
    rows = crm_rows(spark, sf_dir).select(F.concat(F.lit("crm-"), "row_id").alias("id"), F.col("imie_nazwisko").alias("raw"))
    others = table(spark, sf_dir, "customer").selectExpr("concat('c-', c_custkey) as id", "concat('Dr ', c_name, ' o''neil') as raw")
    return apply_rules(rows.unionByName(others), {"name": (normalize_person_name, "raw")}, keep=["id", "raw"])


@query
def split_full_names(spark, sf_dir):
    named = apply_rules(crm_rows(spark, sf_dir), {"name": (normalize_person_name, "imie_nazwisko")}, keep=["row_id"])
    first, rest = split_full_name("name")
    return named.select("row_id", first.alias("imie"), rest.alias("nazwisko"))


@query
def normalize_cities(spark, sf_dir):
    rows = crm_rows(spark, sf_dir).select(F.col("miasto").alias("raw")).unionAll(
        table(spark, sf_dir, "nation").selectExpr("concat('  ', lower(n_name))")
    )
    return rows.groupBy("raw").agg(F.count(F.lit(1)).alias("rows")).select("raw", normalize_city("raw").alias("city"), "rows")


# ---- 2.3 contact, codes, numbers, dates ---------------------------------------------------
def crm_rule(name, rule, column):
    def run(spark, sf_dir):
        return flat(apply_rules(crm_rows(spark, sf_dir), {"value": (rule, column)}, keep=["row_id", column]))

    run.__name__ = name
    return query(run)


crm_rule("normalize_email", normalize_email, "email")
crm_rule("normalize_phone", normalize_phone_pl, "telefon")
crm_rule("normalize_postal_code", normalize_postal_code_pl, "kod_pocztowy")


@query
def phone_from_number_column(spark, sf_dir):
    # digits of the supplied balances, as a spreadsheet column that took phone numbers for numbers
    number = (500000000 + F.floor(F.abs("c_acctbal") * 100)).cast("double")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), number.alias("number"))
    return rows.select("row_id", normalize_phone_pl(plain_text(F.col("number"), "double")).alias("phone"))


@query
def normalize_skus(spark, sf_dir):
    rows = fixture(spark, sf_dir, fixtures.SALES).select("row_id", "sku").unionByName(
        table(spark, sf_dir, "part").selectExpr("p_partkey + 5000000000000 as row_id", "p_brand as sku")
    )
    return apply_rules(rows, {"code": (normalize_sku, "sku")}, keep=["row_id"])


@query
def parse_number(spark, sf_dir):
    rows = crm_rows(spark, sf_dir).selectExpr("row_id", "wartosc_zamowien_pln as raw").unionByName(
        fixture(spark, sf_dir, fixtures.SALES).selectExpr("row_id + 5000000000000 as row_id", "concat(cena_jedn, ' PLN') as raw")
    )
    return apply_rules(rows, {"amount": (parse_pl_number, "raw")}, keep=["row_id"])


@query
def parse_dates(spark, sf_dir):
    rows = crm_rows(spark, sf_dir).selectExpr("row_id", "data_rejestracji as raw").unionByName(
        table(spark, sf_dir, "orders").selectExpr("o_orderkey + 5000000000000 as row_id", "date_format(o_orderdate, 'd/M/yy') as raw")
    )
    return flat(apply_rules(rows, {"day": (parse_mixed_dates, "raw")}, keep=["row_id"]))


@query
def count_text_amounts(spark, sf_dir):
    return fixture(spark, sf_dir, fixtures.CRM_EXPORT).agg(
        F.count_if(~numbers.is_plain_number("wartosc_zamowien_pln")).alias("text_amounts"), F.count(F.lit(1)).alias("rows")
    )


@query
def line_value(spark, sf_dir):
    lines = number_rows(table(spark, sf_dir, "lineitem"))
    return flat(lines.select("row_id", numbers.line_value(F.col("l_quantity"), F.col("l_extendedprice")).alias("value")))


@query
def discount_flag(spark, sf_dir):
    lines = number_rows(table(spark, sf_dir, "lineitem")).select("row_id", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    priced = enrich.enrich(lines.withColumnRenamed("l_partkey", "p_partkey"), table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_partkey", "row_id")
    return priced.select("row_id", numbers.discount_flag(F.col("price"), F.col("p_retailprice")).alias("discounted"))


@query
def month_buckets(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").groupBy(month_bucket("l_shipdate").alias("month"))
    return days.agg(F.count(F.lit(1)).alias("rows"))


@query
def format_locale(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        format_amount(F.col("o_totalprice"), "pl").alias("pl"),
        format_amount(F.col("o_totalprice"), "en").alias("en"),
        format_date(F.col("o_orderdate")).alias("day"),
    )


# ---- 2.1 / 2.4 / 2.5 columns, filters, lookups ------------------------------------------------
@query
def standardize_columns(spark, sf_dir):
    export = crm_rows(spark, sf_dir).selectExpr(
        "wartosc_zamowien_pln as `Wartość zamówień (PLN)`", "id_klienta as `ID klienta`", "imie_nazwisko as ` Imię i nazwisko `",
        "email as `E-MAIL`", "telefon as `tel.`", "miasto as `Miasto`", "kod_pocztowy as `Kod poczt.`", "data_rejestracji as `Data rej.`",
        "row_id as `Lp.`")
    return columns.standardize_columns(export, rulepack.CUSTOMER_HEADERS)


@query
def drop_blank_rows(spark, sf_dir):
    return columns.drop_blank_rows(fixture(spark, sf_dir, fixtures.CRM_EXPORT), crm.RAW).select("row_id", "id_klienta")


@query
def reject_unreadable(spark, sf_dir):
    return quality.split_rejects(sale_rows(spark, sf_dir), sales.REQUIRED)[1].select("row_id", "oddzial", "reason")


@query
def reject_overflow(spark, sf_dir):
    """Prices so high for some rows that their value is no amount of money: rejects, not sales without a value."""
    price = F.when(F.col("row_id") % 100 == 7, F.col("cena_jedn") * 1e16).otherwise(F.col("cena_jedn"))
    rows = sale_rows(spark, sf_dir).withColumn("cena_jedn", price)
    return rows.select("row_id", "oddzial", sales.reject_reason().alias("reason")).filter("reason <> ''")


@query
def validate_many_to_one(spark, sf_dir):
    return enrich.repeated_keys(table(spark, sf_dir, "part").select("p_name"), "p_name")


@query
def null_safe_lookup(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat(nullif(o_orderpriority, '1-URGENT'), case when o_orderkey % 11 = 0 then '?' else '' end) as priority")
    dimension = table(spark, sf_dir, "orders").selectExpr("nullif(o_orderpriority, '1-URGENT') as priority", "length(o_orderpriority) as width").distinct()
    return flat(enrich.null_safe_lookup(facts, dimension, "priority", "o_orderkey"))


@query
def enrich_catalog(spark, sf_dir):
    good, _ = quality.split_rejects(sale_rows(spark, sf_dir), sales.REQUIRED)
    catalog = sales.typed_catalog(fixture(spark, sf_dir, fixtures.CATALOG))
    priced = sales.priced_sales(enrich.enrich(good, catalog, "sku", "row_id", matched="w_katalogu"))
    return flat(priced.select("row_id", "sku", "nazwa_produktu", "kategoria", "cena_katalogowa", "w_katalogu", "rabat", "wartosc_brutto", "miesiac"))


@query
def unmatched_keys(spark, sf_dir):
    catalog = sales.typed_catalog(fixture(spark, sf_dir, fixtures.CATALOG))
    return enrich.unmatched_keys(sale_rows(spark, sf_dir), catalog, "sku")


# ---- 2.6 duplicates and linking ----------------------------------------------------------------
@query
def dedup_exact(spark, sf_dir):
    return dedup.dedup_exact(fixture(spark, sf_dir, fixtures.CRM_EXPORT), "row_id").select("row_id", "copies", "id_klienta")


@query
def dedup_exact_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return dedup.dedup_exact(documents, "doc_id").select("doc_id", "copies", "lang")


@query
def dedup_keep_first(spark, sf_dir):
    kept, _ = dedup.dedup_keep_first(sale_rows(spark, sf_dir), sales.DOCUMENT, "row_id", "nr_transakcji")
    return kept.select("row_id", "oddzial", "nr_transakcji", "sku")


@query
def removed_repeats(spark, sf_dir):
    _, removed = dedup.dedup_keep_first(sale_rows(spark, sf_dir), sales.DOCUMENT, "row_id", "nr_transakcji")
    return removed.select("row_id", "oddzial", "nr_transakcji", "sku")


@query
def link_records(spark, sf_dir):
    linked = linking.link_records(typed_customers(spark, sf_dir), crm.KEY_SETS, "row_id")
    return linked.select("row_id", "group_id", "group_size")


# ---- 2.7 golden records, summaries ------------------------------------------------------------------
@query
def golden_record(spark, sf_dir):
    linked = linking.link_records(typed_customers(spark, sf_dir), crm.KEY_SETS, "row_id")
    return flat(crm.golden_customers(linked, "row_id").select(*crm.CUSTOMER))


def linked_customers(spark, sf_dir) -> DataFrame:
    return linking.link_records(typed_customers(spark, sf_dir), crm.KEY_SETS, "row_id")


@query
def merged_ids(spark, sf_dir):
    return survivorship.membership(linked_customers(spark, sf_dir), "id_klienta")


@query
def merged_id_parts(spark, sf_dir):
    return survivorship.merged_ids(linked_customers(spark, sf_dir), "id_klienta")


def large_groups(spark, sf_dir) -> DataFrame:
    """Line items as members of groups of thousands, by return flag."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "ascii(l_returnflag) + 0L as group_id", "concat('L', l_orderkey, '-', l_linenumber) as id")
    return lines.join(lines.groupBy("group_id").agg(F.count(F.lit(1)).alias("group_size")), "group_id")


@query
def membership_of_large_groups(spark, sf_dir):
    return survivorship.membership(large_groups(spark, sf_dir), "id")


@query
def id_texts_of_large_groups(spark, sf_dir):
    texts = survivorship.long_id_texts(large_groups(spark, sf_dir), "id")
    return texts.select("group_id", F.md5("record_ids").alias("digest"), F.length("record_ids").cast("bigint").alias("chars"))


@query
def link_items(spark, sf_dir):
    """Line items in chains of a thousand, every row linked to the next one; half of the rows of each third chain share a key."""
    rows = fixture(spark, sf_dir, "select row_id from {lineitem}").selectExpr(
        "row_id", "row_id div 1000 as chain", "row_id % 1000 as place")
    keys = rows.selectExpr(
        "row_id", "concat(chain, '/', place div 2) as pair", "concat(chain, '/', (place + 1) div 2) as next_pair",
        "case when chain % 3 = 0 and place % 2 = 0 then 'hot' end as hot")
    linked = linking.link_records(keys, [("pair",), ("next_pair",), ("hot",)], "row_id")
    return linked.select("row_id", "group_id", "group_size")


@query
def pivot_with_totals(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).by_month)


@query
def category_pivot(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).by_category)


@query
def monthly_pivot(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).monthly)


@query
def top_products(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).top_products())


@query
def unmatched_summary(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).unmatched)


@query
def reconcile_totals(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).checks)


@query
def control_difference(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).control_difference)


# ---- 2.8 rows worth showing ----------------------------------------------------------------------------
@query
def messiest_rows(spark, sf_dir):
    raw = [f"raw_{c}" for c in crm.RAW]
    return flat(quality.messiest_rows(typed_customers(spark, sf_dir), raw, "row_id").select("row_id", "score", *raw))


@query
def repaired_rows(spark, sf_dir):
    shown = ["row_id", "score", *crm.DELIVERED, *[f"changed_{c}" for c in crm.RAW[1:]]]
    return flat(crm.repaired_customers(typed_customers(spark, sf_dir), "row_id").select(*shown))


@query
def sample_per_branch(spark, sf_dir):
    sample = sales_tables(spark, sf_dir).sample({"C": 2})
    return flat(sample.select("data", "oddzial", "nr_transakcji", "sku_raw", "sku", "nazwa_produktu", "ilosc", "cena_jedn", "wartosc_brutto"))


# ---- 2.9 quality and audit ----------------------------------------------------------------------------------
@query
def record_issues(spark, sf_dir):
    golden = customer_tables(spark, sf_dir).golden
    return quality.issue_rows(golden, "id_klienta", crm.record_issues())


@query
def city_postal_mismatch(spark, sf_dir):
    rows = typed_customers(spark, sf_dir)
    return rows.filter(quality.postal_mismatch(F.col("miasto"), F.col("kod_pocztowy"))).select("row_id", "miasto", "kod_pocztowy")


@query
def review_queue(spark, sf_dir):
    return flat(customer_tables(spark, sf_dir).to_verify)


@query
def merged_customers(spark, sf_dir):
    return flat(customer_tables(spark, sf_dir).merged)


@query
def clean_customers(spark, sf_dir):
    return flat(customer_tables(spark, sf_dir).final)


@query
def count_changed(spark, sf_dir):
    rows = typed_customers(spark, sf_dir)
    return rows.agg(
        quality.count_changed(F.col("raw_imie_nazwisko"), F.col("full_name")).alias("names"),
        quality.count_changed(F.col("email_txt"), F.col("email")).alias("emails"),
        quality.count_changed(F.col("telefon_txt"), F.col("telefon")).alias("phones"),
        quality.count_changed(F.col("raw_miasto"), F.col("miasto")).alias("cities"),
        quality.count_changed(F.col("kod_pocztowy_txt"), F.col("kod_pocztowy")).alias("postal_codes"),
    )


@query
def change_log(spark, sf_dir):
    return flat(customer_tables(spark, sf_dir).log)


@query
def headline_stats(spark, sf_dir):
    return customer_tables(spark, sf_dir).headline


@query
def sales_log(spark, sf_dir):
    return sales_tables(spark, sf_dir).log.select("step", "category", "count")


@query
def merged_sales(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).final)


# ---- 2.1 sources --------------------------------------------------------------------------------------------------
@query
def merge_branches(spark, sf_dir):
    data, _ = split_exports(spark, sf_dir)
    return flat(sales.merge_branches(data, "row_id").drop("sku_txt"))


@query
def control_totals(spark, sf_dir):
    return flat(split_exports(spark, sf_dir)[1])


# Polish letters and the hard space as they occur in the exports
NATIONAL = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ\xa0"


def in_code_page(value, codec: str):
    """The text with its national characters as single bytes of ``codec``."""
    out = value
    for char in NATIONAL:
        raw = F.unhex(F.lit(char.encode(codec).hex())).cast("string")
        out = F.replace(out, F.lit(char), raw)
    return out


def write_export(spark, body: DataFrame, above: list[str], cells: list, separator: str, codec: str, name: str, ending=None) -> str:
    """Text files under the shared folder, each with the lines ``above`` before its data lines, which may have an ``ending``."""
    line = F.concat_ws(separator, *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cells])
    if ending is not None:
        line = F.concat(line, ending)
    numbered = body.select(line.alias("value"), F.monotonically_increasing_id().alias("n"))
    first = F.col("n") % (1 << 33) == 0
    text = F.when(first, F.concat(F.lit("\n".join([*above, ""])), F.col("value"))).otherwise(F.col("value"))
    path = scratch_path(spark, f"export={name}")
    numbered.select((text if codec == "utf-8" else in_code_page(text, codec)).alias("value")).write.text(path)
    return path


def csv_exports(spark, sf_dir) -> list[str]:
    """The sales as delimited files: UTF-8 with commas, windows-1250 with semicolons, iso-8859-2 with tabs."""
    rows = fixture(spark, sf_dir, fixtures.SALES)
    hard_space = F.replace("cena_jedn", F.lit(",50 "), F.lit(",50\xa0"))
    quoted = F.concat(F.lit('"'), F.col("cena_jedn"), F.lit('"'))
    control = F.unhex(F.lit("88")).cast("string")  # no windows-1250 character
    return [
        write_export(spark, rows.filter("oddzial = 'A'"), ["order_id,order_date,sku,quantity,unit_price"],
                     ["nr_transakcji", "data", "sku", "ilosc", quoted], ",", "utf-8", "A"),
        write_export(spark, rows.filter("oddzial = 'B'"), ["Data;Kod produktu;Ilość;Cena jedn."],
                     ["data", "sku", "ilosc", hard_space], ";", "cp1250", "B"),
        write_export(spark, rows.filter("oddzial = 'C'"), ["Nr paragonu\tData sprzedaży\tSKU\tSzt.\tCena brutto\tŹródło"],
                     ["nr_transakcji", "data", "sku", "ilosc", "cena_jedn", control], "\t", "iso8859_2", "C"),
    ]


def torn_exports(spark, sf_dir) -> list[str]:
    """The same sales with a note that goes over several lines, and in two branches records that do not fit."""
    rows = fixture(spark, sf_dir, fixtures.SALES)
    note = F.when(F.col("row_id") % 7 == 0, F.lit('"said ""hi"";\nthen, left\n"')).when(F.col("row_id") % 7 == 1, F.lit('5" pipe')).otherwise(F.lit(""))

    def ending(separator: str):
        own = F.concat(F.lit(separator), note)
        # a surplus cell, or the note is missing
        return F.when(F.col("row_id") % 50 == 3, F.lit(f"{separator}note{separator}LOST")).when(F.col("row_id") % 50 == 4, F.lit("")).otherwise(own)

    a, b, c = (rows.filter(F.col("oddzial") == x) for x in "ABC")
    # one branch comes in two formats, the second half with another order of columns
    second = F.col("row_id") % 2 == 1
    return [
        write_export(spark, a.filter(~second), ["order_id;order_date;sku;quantity;unit_price;Uwagi"],
                     ["nr_transakcji", "data", "sku", "ilosc", "cena_jedn"], ";", "utf-8", "A1", ending(";")),
        write_export(spark, a.filter(second), ["sku,order_date,order_id,quantity,unit_price,Uwagi,Uwagi"],
                     ["sku", "data", "nr_transakcji", "ilosc", F.concat(F.lit('"'), F.col("cena_jedn"), F.lit('"')), note], ",", "utf-8", "A2", ending(",")),
        write_export(spark, b, ["Data;Kod produktu;Ilość;Cena jedn.;\"Uwagi\ni opis\""],
                     ["data", "sku", "ilosc", "cena_jedn", note], ";", "cp1250", "B"),
        write_export(spark, c, ["Nr paragonu\tData sprzedaży\tSKU\tSzt.\tCena brutto\t"],
                     ["nr_transakcji", "data", "sku", "ilosc", "cena_jedn", note], "\t", "iso8859_2", "C"),
    ]


def torn_branches(spark, sf_dir):
    """The tables of :func:`torn_exports`, with their branch and numbered over all files."""
    files = read_csv_files(spark, torn_exports(spark, sf_dir))
    return [t.withColumn("oddzial", export_name("source_file")) for t in files.tables], files


def export_name(path: str):
    return F.regexp_extract(path, "export=([A-Z])", 1)


@query
def ingest_encoding_profile(spark, sf_dir):
    profile = profile_files(raw_lines(spark, csv_exports(spark, sf_dir)))
    # every part file has one header line
    return profile.groupBy(export_name("file").alias("export"), "encoding").agg((F.sum("lines") - F.count(F.lit(1))).alias("rows"))


@query
def ingest_separator_profile(spark, sf_dir):
    profile = profile_files(raw_lines(spark, csv_exports(spark, sf_dir)))
    return flat(profile.select(export_name("file").alias("export"), "separator", "fields").distinct())


@query
def ingest_mixed_csv(spark, sf_dir):
    tables, _ = torn_branches(spark, sf_dir)
    merged = sales.merge_branches(tables, "row_id")
    return flat(merged.select("oddzial", "nr_transakcji", "data", "sku", "ilosc", "cena_jedn"))


@query
def ingest_rejects(spark, sf_dir):
    _, files = torn_branches(spark, sf_dir)
    return files.rejects.select(export_name("file").alias("export"), "record", "cells", "columns", "reason", "kept")


@query
def ingest_row_ids(spark, sf_dir):
    """Rows, distinct numbers, and rows whose numbers go against the order of their files, per branch."""
    tables, _ = torn_branches(spark, sf_dir)
    rows = reduce(DataFrame.unionByName, [t.select("oddzial", "source_file", "row_id") for t in tables])
    files = rows.groupBy("oddzial", "source_file").agg(F.min("row_id").alias("least"), F.max("row_id").alias("greatest"), F.count(F.lit(1)).alias("n"))
    # ranges of numbers of the files, in the order of their names, do not meet
    before = F.max("greatest").over(Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1))
    late = files.withColumn("late", F.coalesce((F.col("least") <= before).cast("int"), F.lit(0)))
    counts = late.groupBy("oddzial").agg(F.sum("n").alias("rows"), F.sum("late").alias("late_files"))
    return counts.join(rows.groupBy("oddzial").agg(F.count_distinct("row_id").alias("ids")), "oddzial")


def sales_files(spark, sf_dir) -> sales.SalesFiles:
    """The job on files: exports with total rows, the sales of branch A in two formats that share documents."""
    rows = exports(spark, sf_dir)
    a, b, c = (rows.filter(F.col("oddzial") == x) for x in "ABC")
    again = F.col("row_id") >= 1_000_000_000_000  # exported twice, and the total row
    paths = [
        write_export(spark, a.filter(~again), ["order_date,order_id,sku,quantity,unit_price,value"],
                     ["data", "nr_transakcji", "sku", "ilosc", F.concat(F.lit('"'), F.col("cena_jedn"), F.lit('"')), "wartosc"], ",", "utf-8", "A1"),
        write_export(spark, a.filter(again), ["Data;Nr paragonu;SKU;Szt.;Cena brutto;Suma"],
                     ["data", "nr_transakcji", "sku", "ilosc", "cena_jedn", "wartosc"], ";", "cp1250", "A2"),
        write_export(spark, b, ["Data;Kod produktu;Ilość;Cena jedn.;Wartość"],
                     ["data", "sku", "ilosc", "cena_jedn", "wartosc"], ";", "cp1250", "B"),
        write_export(spark, c, ["Data sprzedaży\tNr paragonu\tSKU\tSzt.\tCena brutto\tSuma"],
                     ["data", "nr_transakcji", "sku", "ilosc", "cena_jedn", "wartosc"], "\t", "iso8859_2", "C"),
    ]
    catalog = write_export(spark, fixture(spark, sf_dir, fixtures.CATALOG), ["SKU;Nazwa produktu;Kategoria;Cena katalogowa"],
                           ["sku", "nazwa_produktu", "kategoria", "cena_katalogowa"], ";", "utf-8", "K")
    return sales.from_files(spark, paths, catalog, export_name("source_file"))


@query
def sales_job_from_files(spark, sf_dir):
    """The accepted sales, without their numbers: those of files are their own."""
    return flat(sales_files(spark, sf_dir).sales.final)


@query
def sales_checks_from_files(spark, sf_dir):
    return flat(sales_files(spark, sf_dir).sales.checks)


@query
def customers_from_files(spark, sf_dir):
    rows = fixture(spark, sf_dir, fixtures.CRM_EXPORT).repartitionByRange(4, "row_id").sortWithinPartitions("row_id")
    cells = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in crm.RAW]
    path = write_export(spark, rows, ["ID klienta;Imię i nazwisko;E-mail;Telefon;Miasto;Kod pocztowy;Data rejestracji;Wartość zamówień (PLN)"], cells, ";", "utf-8", "K")
    return flat(crm.from_files(spark, path).customers.final)


def sheet_rows(spark, sf_dir) -> DataFrame:
    """Each branch as a sheet of cells: a title, an empty row, the header, the data."""
    rows = fixture(spark, sf_dir, fixtures.SALES)
    nothing = ["cast(null as string)"] * 4
    data = rows.selectExpr("oddzial as source_file", "row_id as row_no", "nr_transakcji as c0", "data as c1", "sku as c2", "nullif(ilosc, '?') as c3", "cena_jedn as c4")
    branches = rows.select(F.col("oddzial").alias("source_file")).distinct()
    title = branches.selectExpr("source_file", "-3L", "concat('Raport sprzedaży ', source_file)", *nothing)
    empty = branches.selectExpr("source_file", "-2L", nothing[0], *nothing)
    header = branches.selectExpr("source_file", "-1L", "' Nr paragonu '", "'Data sprzedaży'", "'SKU'", "'Szt.'", "'Cena brutto'")
    return data.unionAll(title).unionAll(empty).unionAll(header)


@query
def detect_header_rows(spark, sf_dir):
    return detect_header_row(sheet_rows(spark, sf_dir))


@query
def ingest_grid(spark, sf_dir):
    """All branches as grids: titles and empty rows above the header, remarks of several lines in a column without a name."""
    rows = fixture(spark, sf_dir, fixtures.SALES)
    # a row with a remark lacks its quantity, so that no row is fuller than the header
    unknown = F.col("ilosc") == "?"
    remark, quantity = F.when(unknown, F.lit('"left\nand right"')).otherwise(F.lit("")), F.when(~unknown, F.col("ilosc"))
    kinds = [
        ("A", ";", "utf-8", [" Nr paragonu ", "Data sprzedaży", "SKU", "", "Szt.", "Cena brutto"]),
        ("B", ";", "cp1250", ["Nr paragonu", "Data", "Kod produktu", "", "Ilość", "Cena jedn."]),
        ("C", "\t", "iso8859_2", ["order_id", "order_date", "SKU", "", "quantity", "Cena brutto"]),
    ]
    paths = []
    for name, separator, codec, header in kinds:
        above = [separator.join(["Raport sprzedaży", *[""] * 5]), separator * 5, separator.join(header)]
        cells = ["nr_transakcji", "data", "sku", remark, quantity, "cena_jedn"]
        paths.append(write_export(spark, rows.filter(F.col("oddzial") == name), above, cells, separator, codec, name))
    tables = [t.withColumn("oddzial", export_name("source_file")).withColumnRenamed("row_no", "row_id") for t in read_grid_smart(spark, paths)]
    merged = sales.merge_branches(tables, "row_id")
    return flat(merged.select("oddzial", "nr_transakcji", "data", "sku", "ilosc", "cena_jedn"))


# ---- sinks ----------------------------------------------------------------------------------------
@query
def locale_csv(spark, sf_dir):
    good, _ = quality.split_rejects(sale_rows(spark, sf_dir), sales.REQUIRED)
    value = numbers.line_value(F.col("ilosc"), F.col("cena_jedn")).alias("wartosc_brutto")
    path = scratch_path(spark, "locale-csv")
    write_locale_csv(good.select("row_id", "oddzial", "data", "sku", "ilosc", "cena_jedn", value), path)
    return read_locale_csv(spark, path)


@query
def locale_csv_floats(spark, sf_dir):
    """Doubles of every size, written and read back as text."""
    number = F.expr("cast(concat(l_linenumber, '.', l_suppkey % 90 + 10, 'e', l_partkey % 60 - 30) as double)")
    rows = fixture(spark, sf_dir, "select row_id, l_linenumber, l_suppkey, l_partkey from {lineitem}").select("row_id", number.alias("value"))
    path = scratch_path(spark, "locale-floats")
    write_locale_csv(rows, path)
    return read_locale_csv(spark, path).select(F.col("row_id").cast("bigint").alias("row_id"), "value")


@query
def report_manifest(spark, sf_dir):
    tables = sales_tables(spark, sf_dir).report_tables()
    return write_report(tables, scratch_path(spark, "report"))


@query
def delivered_order(spark, sf_dir):
    """The promised order of both bundles, proven from the manifest of their parts."""
    proofs = []
    for name, job, order in (("sales", sales_tables(spark, sf_dir), sales.REPORT_ORDER), ("customers", customer_tables(spark, sf_dir), crm.REPORT_ORDER)):
        path = scratch_path(spark, name)
        write_report(job.report_tables(), path, order)
        proofs.append(bundle.delivered_order(spark, path).select(F.lit(name).alias("bundle"), "*"))
    return proofs[0].unionByName(proofs[1])


@query
def sales_headline(spark, sf_dir):
    return flat(sales_tables(spark, sf_dir).headline)
