"""Customer cleaning: raw CRM export -> golden customers, review list, merged list, change log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.contact import (
    normalize_email,
    normalize_phone_pl,
    normalize_postal_code_pl,
)
from sparktidy.functions.dates import parse_mixed_dates
from sparktidy.functions.numbers import is_plain_number, parse_pl_number, to_money
from sparktidy.functions.render import format_date
from sparktidy.functions.rule import apply_rules
from sparktidy.functions.text import (
    city_rule,
    clean_text,
    normalize_key,
    normalize_person_name,
    split_full_name,
)
from sparktidy.operators import quality
from sparktidy.operators.columns import standardize_columns
from sparktidy.operators.dedup import dedup_exact
from sparktidy.operators.linking import link_records
from sparktidy.operators.quality import Step
from sparktidy.operators.survivorship import golden_records, membership, merged_ids, sorted_ids, with_id_text
from sparktidy.sources.delimited import SOURCE_FILE, read_csv_files
from sparktidy.workspace import stage, stage_counted

RAW = list(rulepack.CUSTOMER_HEADERS)
ISSUE_FIELDS = {"email": "e-mail", "telefon": "telefon", "data_rejestracji": "data rejestracji"}
# same e-mail, or same name and phone; a name alone never links
KEY_SETS = (("email",), ("match_name", "telefon"))
SURVIVORS = ("id_klienta", "imie", "nazwisko", "email", "telefon", "miasto", "kod_pocztowy")
CUSTOMER = (
    *SURVIVORS,
    "data_rejestracji",
    "wartosc_zamowien_pln",
    "liczba_rekordow",
    "scalone_id",
    "do_sprawdzenia",
)
DELIVERED = ("imie", "nazwisko", "email", "telefon", "miasto", "kod_pocztowy", "data_rejestracji", "wartosc_zamowien_pln")


REPORT_ORDER = {"klienci": ["id_klienta"], "scalone_duplikaty": ["id_klienta"], "do_weryfikacji": ["id_klienta"], "log_zmian": ["step_no"]}


def distinct_rows(
    df: DataFrame, row_id: str, synonyms: Mapping[str, Iterable[str]] = rulepack.CUSTOMER_HEADERS
) -> DataFrame:
    """Canonical text columns, one row per distinct row with ``copies``; blank rows still in."""
    return dedup_exact(standardize_columns(df, synonyms, keep=[row_id]), row_id)


def typed_rows(distinct: DataFrame, row_id: str) -> DataFrame:
    """Raw, cleaned (``*_txt``) and typed columns side by side; ``blank`` marks empty rows.

    Raw columns are called ``raw_*``.  A narrow projection throughout.
    """
    renamed = distinct.select(
        row_id, "copies", *[F.col(c).alias(f"raw_{c}") for c in RAW]
    )
    raw = [f"raw_{c}" for c in RAW]
    cleaned = apply_rules(
        renamed, {f"{c}_txt": (clean_text, f"raw_{c}") for c in RAW}, keep=[row_id, "copies", *raw]
    )
    texts = [f"{c}_txt" for c in RAW]
    rules = {
        "full_name": (normalize_person_name.after(clean_text), "imie_nazwisko_txt"),
        "email": (normalize_email.after(clean_text), "email_txt"),
        "telefon": (normalize_phone_pl.after(clean_text), "telefon_txt"),
        "city_key": (normalize_key.after(clean_text), "miasto_txt"),
        "kod_pocztowy": (normalize_postal_code_pl.after(clean_text), "kod_pocztowy_txt"),
        "data_rejestracji": (parse_mixed_dates.after(clean_text), "data_rejestracji_txt"),
        "amount": (parse_pl_number.after(clean_text), "wartosc_zamowien_pln_txt"),
    }
    typed = apply_rules(cleaned, rules, keep=[row_id, "copies", *raw, *texts])
    first, last = split_full_name("full_name")
    return typed.select(
        row_id,
        "copies",
        *raw,
        *texts,
        F.coalesce(*texts).isNull().alias("blank"),
        F.col("id_klienta_txt").alias("id_klienta"),
        "full_name",
        first.alias("imie"),
        last.alias("nazwisko"),
        "email",
        "telefon",
        city_rule()(F.col("miasto_txt"), F.col("city_key")).alias("miasto"),
        "kod_pocztowy",
        "data_rejestracji",
        to_money(F.col("amount")).alias("wartosc_zamowien_pln"),
    ).withColumn("match_name", F.concat(F.lower("imie"), F.lit(" "), F.lower("nazwisko")))


def cleaning_steps() -> list[Step]:
    """Counts over :func:`typed_rows`; ``copies`` carries what blank and exact-duplicate removal took."""
    kept = ~F.col("blank")

    def changed(before: str, after: str) -> Column:
        return F.count_if(kept & quality.differs(F.col(before), F.col(after)))

    return [
        Step("Wiersze w pliku wejściowym", "rows", F.sum("copies")),
        Step("Usunięte puste wiersze", "removed", F.sum(F.when(F.col("blank"), F.col("copies")))),
        Step("Usunięte identyczne wiersze (wklejone dwa razy)", "removed", F.sum(F.when(kept, F.col("copies") - 1))),
        Step("Poprawione imiona i nazwiska (wielkość liter, spacje, tytuły)", "standardized", changed("raw_imie_nazwisko", "full_name")),
        Step("Ujednolicone adresy e-mail", "standardized", changed("email_txt", "email")),
        Step("Telefony sprowadzone do formatu +48 XXX XXX XXX", "standardized", changed("telefon_txt", "telefon")),
        Step("Ujednolicone nazwy miast", "standardized", changed("raw_miasto", "miasto")),
        Step("Poprawione kody pocztowe (w tym utracone zera z Excela)", "standardized", changed("kod_pocztowy_txt", "kod_pocztowy")),
        Step("Daty z różnych formatów zamienione na RRRR-MM-DD", "standardized", F.count_if(kept & F.col("data_rejestracji").isNotNull())),
        Step("Kwoty tekstowe ('1 234,50 zł') zamienione na liczby", "standardized", F.count_if(kept & ~is_plain_number("raw_wartosc_zamowien_pln"))),
    ]


def outcome_steps() -> list[Step]:
    """Counts over the golden customers."""
    return [
        Step("Scalone duplikaty klientów (ten sam e-mail lub imię+nazwisko+telefon)", "merged", F.sum(F.col("liczba_rekordow") - 1)),
        Step("Klienci w wyniku końcowym", "rows", F.count(F.lit(1))),
        Step("Rekordy oznaczone do ręcznej weryfikacji", "flagged", F.count_if(F.col("do_sprawdzenia") != "")),
    ]


def record_issues(raw_suffix: str = "_txt") -> dict[str, Column]:
    issues = {
        c: quality.field_issue(c, f"{c}{raw_suffix}", label) for c, label in ISSUE_FIELDS.items()
    }
    issues["kod_pocztowy"] = quality.postal_issue("miasto", "kod_pocztowy")
    return issues


def golden_customers(linked: DataFrame, row_id: str) -> DataFrame:
    """One row per linked group, with the review text; keeps ``group_id`` and the raw issue texts."""
    raw = [f"{c}_txt" for c in ISSUE_FIELDS]
    amount = F.col("wartosc_zamowien_pln")
    golden = golden_records(
        linked,
        [*SURVIVORS, *raw],
        "data_rejestracji",
        row_id,
        extra={
            "data_rejestracji": (F.min("data_rejestracji"), F.col("data_rejestracji")),
            "wartosc_zamowien_pln": (F.sum(amount).cast("decimal(28,2)"), amount.cast("decimal(28,2)")),
            "liczba_rekordow": (F.count(F.lit(1)), F.lit(1).cast("bigint")),
            "scalone_id": (sorted_ids("id_klienta"), F.coalesce("id_klienta", F.lit(""))),
        },
    )
    golden = with_id_text(golden, linked, "id_klienta", "scalone_id")
    return golden.withColumn("do_sprawdzenia", quality.join_issues(list(record_issues().values())))


@dataclass
class CustomerTables:
    """All results of the customer job; each is a lazy table over staged intermediates."""

    typed: DataFrame
    linked: DataFrame
    golden: DataFrame
    row_id: str
    counts: tuple[dict, dict]  # of the cleaning and the outcome steps, taken while the tables were written

    @property
    def customers(self) -> DataFrame:
        return self.golden.select(*CUSTOMER)

    @property
    def final(self) -> DataFrame:
        return self.customers.drop("scalone_id")

    @property
    def to_verify(self) -> DataFrame:
        return self.customers.filter("do_sprawdzenia != ''")

    @property
    def merged(self) -> DataFrame:
        return self.customers.filter("liczba_rekordow > 1").select(
            "id_klienta", "imie", "nazwisko", "email", "liczba_rekordow", "scalone_id", "wartosc_zamowien_pln"
        )

    @property
    def members(self) -> DataFrame:
        """Every merged customer id with its group and position."""
        return membership(self.linked, "id_klienta")

    @property
    def merged_id_lists(self) -> DataFrame:
        """Id lists of merged customers, whole, in parts of bounded length."""
        return merged_ids(self.linked, "id_klienta")

    @property
    def log(self) -> DataFrame:
        spark = self.typed.sparkSession
        logs = zip((cleaning_steps(), outcome_steps()), self.counts)
        return quality.join_logs([(quality.written_log(spark, steps, counts), len(steps)) for steps, counts in logs])

    @property
    def headline(self) -> DataFrame:
        return headline_stats(self.log)

    def messiest(self, n: int = 6) -> DataFrame:
        """Before / after of the rows that needed most tidying."""
        raw = [f"raw_{c}" for c in RAW]
        return quality.messiest_rows(self.typed.filter("not blank"), raw, self.row_id, n)

    def repaired(self, n: int = 6) -> DataFrame:
        return repaired_customers(self.typed.filter("not blank"), self.row_id, n)

    def report_tables(self) -> dict[str, DataFrame]:
        """The delivered tables, in delivery order."""
        tables = {"klienci": self.final, "scalone_duplikaty": self.merged, "do_weryfikacji": self.to_verify, "log_zmian": self.log}
        return {name: table.orderBy(*REPORT_ORDER[name]) for name, table in tables.items()}


def headline_stats(log: DataFrame) -> DataFrame:
    """Rows in, customers, merged, standardized cells and rows to verify, by step category."""

    def total(category: str, last: bool = False) -> Column:
        rows = F.when(F.col("category") == category, F.col("count"))
        return F.max_by(rows, F.when(rows.isNotNull(), F.col("step_no"))) if last else F.sum(rows)

    first_rows = F.min_by("count", F.when(F.col("category") == "rows", F.col("step_no")))
    return log.agg(
        first_rows.alias("rows_in"),
        total("rows", last=True).alias("customers"),
        total("merged").alias("merged"),
        total("standardized").alias("standardized"),
        total("flagged").alias("to_verify"),
    )


def repaired_customers(typed: DataFrame, row_id: str, n: int = 6) -> DataFrame:
    amount = F.col("wartosc_zamowien_pln")
    raw_amount = F.col("raw_wartosc_zamowien_pln")
    same_amount = F.coalesce(
        F.when(is_plain_number(raw_amount), to_money(raw_amount.try_cast("double")) == amount), F.lit(False)
    )
    targets = {
        "imie_nazwisko": F.concat(F.col("imie"), F.lit(" "), F.col("nazwisko")),
        **{c: F.col(c) for c in ("email", "telefon", "miasto", "kod_pocztowy")},
        "data_rejestracji": format_date(F.col("data_rejestracji")),
    }
    changed = {c: quality.cell_changed(F.col(f"raw_{c}"), target) for c, target in targets.items()}
    changed["wartosc_zamowien_pln"] = (
        quality.cell_changed(raw_amount, amount.cast("string")) & ~same_amount
    )
    return quality.repaired_rows(typed, changed, DELIVERED, row_id, n)


def typed_customers(raw: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Distinct typed rows, staged: the linking rounds and the golden records read them."""
    return stage(typed_rows(distinct_rows(raw, row_id), row_id), "customers-typed")


def clean_customers(raw: DataFrame, row_id: str = "row_id") -> CustomerTables:
    """Run the job on a raw table with any of the known header spellings plus a row id.

    The change log is counted while the typed rows and the golden customers are written.
    """
    rows = typed_rows(distinct_rows(raw, row_id), row_id)
    typed, cleaned = stage_counted(rows, "customers-typed", quality.step_counts(cleaning_steps()))
    linked = link_records(typed.filter("not blank"), KEY_SETS, row_id)
    golden, outcome = stage_counted(golden_customers(linked, row_id), "customers-golden", quality.step_counts(outcome_steps()))
    return CustomerTables(typed, linked, golden, row_id, (cleaned, outcome))


@dataclass
class CustomerFiles:
    """What :func:`from_files` read: the customers, the records it could not read, one row per file."""

    customers: CustomerTables
    unread: DataFrame
    profile: DataFrame


def from_files(
    spark: SparkSession, paths: Sequence[str] | str, row_id: str = "row_id", synonyms: Mapping[str, Iterable[str]] = rulepack.CUSTOMER_HEADERS
) -> CustomerFiles:
    """Clean customer files of any format and header; rows are numbered over all of them."""
    read = read_csv_files(spark, paths, row_id)
    tables = [standardize_columns(t.drop(SOURCE_FILE), synonyms, keep=[row_id]) for t in read.tables]
    return CustomerFiles(clean_customers(reduce(DataFrame.unionByName, tables), row_id), read.rejects, read.profile)
