"""Sales merge: branch exports + product catalog -> one sales table, checks and summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.codes import normalize_sku
from sparktidy.functions.dates import month_bucket, parse_mixed_dates
from sparktidy.functions.numbers import discount_flag, line_value, parse_pl_number
from sparktidy.functions.rule import apply_rules
from sparktidy.functions.text import clean_text
from sparktidy.operators import quality, summarize
from sparktidy.operators.columns import standardize_columns, with_optional_column
from sparktidy.operators.dedup import mark_repeats
from sparktidy.operators.enrich import null_safe_lookup, validate_many_to_one
from sparktidy.operators.quality import Step
from sparktidy.sources.delimited import SOURCE_FILE, read_csv_files
from sparktidy.sources.totals import extract_control_totals
from sparktidy.workspace import stage

DOCUMENT = ("oddzial", "nr_transakcji", "sku")
REQUIRED = ("data", "ilosc", "cena_jedn")
TYPED = ("oddzial", "nr_transakcji", "data", "sku_raw", "sku", "ilosc", "cena_jedn")
MERGED = (
    "data", "miesiac", "oddzial", "nr_transakcji", "sku", "nazwa_produktu", "kategoria",
    "ilosc", "cena_jedn", "cena_katalogowa", "rabat", "wartosc_brutto",
)
# what summaries read
SUMMED = ("oddzial", "sku", "sku_fixed", "is_repeat", "miesiac", "kategoria", "reason", "w_katalogu", "wartosc_brutto")
_ACCEPTED = "not is_repeat and reason = ''"


REPORT_ORDER = {
    "dane": ["data", "oddzial"],
    "miesiace_x_oddzialy": ["miesiac"],
    "kategorie": ["kategoria"],
    "brak_w_katalogu": ["oddzial", "sku"],
    "sumy_kontrolne": ["oddzial"],
    "odrzucone": ["oddzial", "data"],
    "zdublowane": ["oddzial", "data"],
    "log_zmian": ["step_no", "step"],
}


def canonical_sales(
    df: DataFrame, row_id: str, source: str, synonyms: Mapping[str, Iterable[str]] = rulepack.SALE_HEADERS
) -> DataFrame:
    """Canonical text columns of one export; a missing document number becomes null."""
    with_id = with_optional_column(df, "nr_transakcji", synonyms["nr_transakcji"])
    return standardize_columns(with_id, synonyms, keep=[row_id, source])


def whole_number(value: Column) -> Column:
    """Quantity; a fractional one is unreadable and ends among the rejects."""
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def typed_sales(canonical: DataFrame, row_id: str, source: str = "oddzial") -> DataFrame:
    keep = [row_id, source]
    texts = {"nr_txt": "nr_transakcji", "data_txt": "data", "sku_txt": "sku", "ilosc_txt": "ilosc", "cena_txt": "cena_jedn"}
    cleaned = apply_rules(
        canonical.withColumnRenamed("sku", "sku_raw"),
        {new: (clean_text, "sku_raw" if old == "sku" else old) for new, old in texts.items()},
        keep=[*keep, "sku_raw"],
    )
    typed = apply_rules(
        cleaned,
        {
            "data": (parse_mixed_dates.after(clean_text), "data_txt"),
            "sku": (normalize_sku.after(clean_text), "sku_txt"),
            "quantity": (parse_pl_number.after(clean_text), "ilosc_txt"),
            "cena_jedn": (parse_pl_number.after(clean_text), "cena_txt"),
        },
        keep=[*keep, "sku_raw", "sku_txt", "nr_txt"],
    )
    return typed.select(
        *keep,
        F.col("nr_txt").alias("nr_transakcji"),
        "data",
        "sku_raw",
        "sku_txt",
        "sku",
        whole_number(F.col("quantity")).alias("ilosc"),
        "cena_jedn",
    )


def merge_branches(branches: Iterable[DataFrame], row_id: str, source: str = "oddzial") -> DataFrame:
    """Append exports with different headers, then type them all in one projection.

    Each export carries ``source`` and a row id.
    """
    canonical = [canonical_sales(branch, row_id, source) for branch in branches]
    return typed_sales(reduce(DataFrame.unionByName, canonical), row_id, source)


def typed_catalog(df: DataFrame, synonyms: Mapping[str, Iterable[str]] = rulepack.CATALOG_HEADERS) -> DataFrame:
    return apply_rules(
        standardize_columns(df, synonyms),
        {"sku": (normalize_sku, "sku"), "cena_katalogowa": (parse_pl_number, "cena_katalogowa")},
        keep=["nazwa_produktu", "kategoria"],
    ).select("sku", "nazwa_produktu", "kategoria", "cena_katalogowa")


def reject_reason() -> Column:
    """Unreadable required columns, or a value too large for an amount of money; empty for a good row."""
    too_large = F.col("ilosc").isNotNull() & F.col("cena_jedn").isNotNull() & line_value(F.col("ilosc"), F.col("cena_jedn")).isNull()
    return F.concat_ws(", ", F.nullif(quality.unreadable(REQUIRED), F.lit("")), F.when(too_large, F.lit("wartosc_brutto")))


def valued_sales(rows: DataFrame) -> DataFrame:
    """Derived columns that the row itself tells."""
    return rows.withColumns({"wartosc_brutto": line_value(F.col("ilosc"), F.col("cena_jedn")), "miesiac": month_bucket("data")})


def known_category() -> Column:
    return F.coalesce("kategoria", F.lit(rulepack.NOT_IN_CATALOG))


def priced_sales(matched: DataFrame) -> DataFrame:
    """Derived columns of the merged table."""
    discounted = discount_flag(F.col("cena_jedn"), F.col("cena_katalogowa"))
    return valued_sales(matched).withColumns({"kategoria": known_category(), "rabat": discounted})


@dataclass
class SalesTables:
    """All results of the merge.

    ``marked`` has all rows with ``is_repeat``, ``lookup`` joins rows with columns of the catalog.  The outputs are filters
    and aggregates over one of two tables, each staged when first wanted: ``every`` with all columns, ``amounts`` with the few
    that summaries read, which are all that is shuffled for it.  ``final`` alone needs neither.
    """

    marked: DataFrame
    lookup: Callable[..., DataFrame]
    controls: DataFrame
    row_id: str

    @property
    def _priced(self) -> DataFrame:
        # what the row itself tells is added behind the shuffle
        priced = priced_sales(self.lookup(self.marked))
        own = self.marked.columns
        return priced.withColumn("reason", reject_reason()).select(*own, "reason", *priced.columns[len(own) :])

    @cached_property
    def every(self) -> DataFrame:
        """All rows and columns, with ``is_repeat`` and ``reason``."""
        return stage(self._priced, "sales")

    @cached_property
    def amounts(self) -> DataFrame:
        """:data:`SUMMED` of all rows; values go through the shuffle in place of the columns they come from."""
        if "every" in self.__dict__:
            return self.every
        valued = valued_sales(self.marked).withColumn("reason", reject_reason())
        known = [c for c in SUMMED if c in valued.columns]
        matched = self.lookup(valued.select(self.row_id, *known), ["kategoria"])
        return stage(matched.withColumn("kategoria", known_category()).select(*SUMMED), "amounts")

    @property
    def sales(self) -> DataFrame:
        return self.every.filter(_ACCEPTED)

    @property
    def final(self) -> DataFrame:
        """The merged table, from ``every`` if that is there, else computed where it is written."""
        rows = self.every if "every" in self.__dict__ else self._priced
        return rows.filter(_ACCEPTED).select(*MERGED)

    @property
    def delivered(self) -> DataFrame:
        """``final`` in the order of the report; what the row itself tells is added behind the sort."""
        told = ("miesiac", "rabat", "wartosc_brutto")
        ordered = self.final.select(*[c for c in MERGED if c not in told]).orderBy(*REPORT_ORDER["dane"])
        return priced_sales(ordered).select(*MERGED)

    @property
    def repeats(self) -> DataFrame:
        return self.every.filter("is_repeat").select(*TYPED)

    @property
    def rejects(self) -> DataFrame:
        return self.every.filter("not is_repeat and reason <> ''").select(*TYPED, "reason")

    @cached_property
    def cube(self) -> DataFrame:
        """Revenue by month, category and branch: the one aggregate of the facts that all pivots roll up."""
        cells = self.amounts.filter(_ACCEPTED).groupBy("miesiac", "kategoria", "oddzial").agg(F.sum("wartosc_brutto").alias("wartosc_brutto"))
        return stage(cells, "sales-cube")

    @property
    def by_month(self) -> DataFrame:
        return summarize.pivot_with_totals(self.cube, "miesiac", "oddzial", "wartosc_brutto")

    @property
    def by_category(self) -> DataFrame:
        return summarize.pivot_with_totals(self.cube, "kategoria", "oddzial", "wartosc_brutto")

    @property
    def monthly(self) -> DataFrame:
        return summarize.pivot_sum(self.cube, "miesiac", "oddzial", "wartosc_brutto")

    def top_products(self, n: int = 10) -> DataFrame:
        return top_products(self.sales, n)

    @property
    def unmatched(self) -> DataFrame:
        return unmatched_summary(self.amounts.filter(_ACCEPTED))

    @property
    def checks(self) -> DataFrame:
        """Declared totals beside what was kept, left out as a repeat, and rejected."""
        apart = {"kwota_powtorek": F.col("is_repeat"), "kwota_odrzuconych": F.expr("not is_repeat and reason <> ''")}
        return summarize.reconcile(self.amounts, self.controls, "oddzial", "wartosc_brutto", kept=F.expr(_ACCEPTED), apart=apart)

    @property
    def control_difference(self) -> DataFrame:
        return summarize.total_difference(self.checks)

    @property
    def log(self) -> DataFrame:
        return sales_log(self.amounts, self.controls)

    @property
    def headline(self) -> DataFrame:
        """The figures of the summary: rows in, sales, repaired codes, what was left out, and the control difference."""
        accepted = F.expr(_ACCEPTED)
        totals = self.amounts.agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(accepted).alias("sales"),
            F.count_if("sku_fixed").alias("fixed_skus"),
            F.count_if("is_repeat").alias("repeats"),
            F.count_if(F.expr("not is_repeat and reason <> ''")).alias("rejects"),
            F.count_if(accepted & ~F.col("w_katalogu")).alias("unmatched"),
            F.coalesce(F.sum(F.when(accepted, F.col("wartosc_brutto"))), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
        )
        gap = self.control_difference.first()["control_difference"]
        return totals.withColumn("control_difference", F.lit(gap).cast("decimal(38,2)"))

    def sample(self, sizes: dict[str, int], default: int = 1) -> DataFrame:
        return branch_sample(self.sales, self.row_id, sizes, default)

    def report_tables(self) -> dict[str, DataFrame]:
        """The delivered tables, in delivery order."""
        _ = self.every  # written first, so that all of them read it
        tables = {
            "dane": self.delivered,
            "miesiace_x_oddzialy": self.by_month,
            "kategorie": self.by_category,
            "top10_produktow": self.top_products(),
            "brak_w_katalogu": self.unmatched,
            "sumy_kontrolne": self.checks,
            "odrzucone": self.rejects,
            "zdublowane": self.repeats,
            "log_zmian": self.log,
        }
        # the ranking is in its own order
        return {name: table.orderBy(*REPORT_ORDER[name]) if name in REPORT_ORDER and name != "dane" else table for name, table in tables.items()}


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    return summarize.top_groups(
        sales,
        ["sku", "nazwa_produktu"],
        {"sprzedane_szt": F.sum("ilosc"), "przychod": F.sum("wartosc_brutto")},
        by="przychod",
        n=n,
    )


def unmatched_summary(sales: DataFrame) -> DataFrame:
    """Sales without a catalog entry per branch and code; rows without a code stay visible."""
    return sales.filter("not w_katalogu").groupBy("oddzial", "sku").agg(
        F.count(F.lit(1)).alias("transakcje"), F.sum("wartosc_brutto").alias("wartosc")
    )


def branch_sample(sales: DataFrame, row_id: str, sizes: dict[str, int], default: int = 1) -> DataFrame:
    """Matched rows in output order, those with a repaired code first choice."""
    return summarize.sample_per_group(
        sales.filter("w_katalogu"),
        "oddzial",
        F.coalesce(F.col("sku_raw"), F.lit("")) != F.col("sku"),
        ["data", row_id],
        sizes,
        default,
    )


def sales_log(every: DataFrame, controls: DataFrame) -> DataFrame:
    """``(step_no, step, category, count)``: per branch first (step 0), then the merged table.

    One aggregate per branch carries all counts.
    """
    accepted = F.expr(_ACCEPTED)
    counts = {
        "loaded": F.count(F.lit(1)),
        "fixed": F.count_if("sku_fixed"),
        "repeats": F.count_if("is_repeat"),
        "rejects": F.count_if(F.expr("not is_repeat and reason <> ''")),
        "unmatched": F.count_if(accepted & ~F.col("w_katalogu")),
        "accepted": F.count_if(accepted),
    }
    per_branch = every.groupBy("oddzial").agg(*[c.alias(n) for n, c in counts.items()])

    def entry(category: str, what: str, count: Column) -> Column:
        return F.struct(
            F.lit(category).alias("category"), F.lit(what).alias("what"), count.alias("count")
        )

    entries = F.array(
        entry("removed", "usunięty wiersz podsumowania (RAZEM)", F.col("total_rows")),
        entry("rows", "wczytane transakcje", F.col("loaded")),
        entry("standardized", "ujednolicone kody SKU", F.nullif(F.col("fixed"), F.lit(0))),
    )
    branches = (
        per_branch.join(controls.select("oddzial", "total_rows"), "oddzial", "left")
        .select("oddzial", F.inline(entries))
        .filter("count is not null")
        .select(
            F.lit(0).alias("step_no"),
            F.concat_ws(": ", "oddzial", "what").alias("step"),
            "category",
            "count",
        )
    )
    merged = quality.change_log(
        per_branch,
        [
            Step("Usunięte zdublowane transakcje (ten sam nr dokumentu wyeksportowany 2x)", "removed", F.sum("repeats")),
            Step("Wiersze z nieczytelną datą/ilością/ceną", "removed", F.sum("rejects")),
            Step("Transakcje bez dopasowania w katalogu (do wyjaśnienia z klientem)", "flagged", F.sum("unmatched")),
            Step("Transakcje w pliku wynikowym", "rows", F.sum("accepted")),
        ],
    )
    return branches.unionByName(merged)


def merge_sales(
    typed: DataFrame, catalog: DataFrame, controls: DataFrame, row_id: str = "row_id"
) -> SalesTables:
    """``typed`` from :func:`merge_branches`, ``catalog`` from :func:`typed_catalog`."""
    # of the cleaned code only one bit is wanted later
    fixed = F.coalesce("sku_txt", F.lit("")) != F.coalesce("sku", F.lit(""))
    typed = stage(typed.withColumn("sku_fixed", fixed).drop("sku_txt"), "sales-typed")
    catalog, controls = stage(catalog, "catalog"), stage(controls, "controls")
    marked = mark_repeats(typed, DOCUMENT, row_id, F.col("nr_transakcji").isNotNull())
    validate_many_to_one(catalog, "sku")

    def lookup(rows: DataFrame, columns: Sequence[str] = ("nazwa_produktu", "kategoria", "cena_katalogowa")) -> DataFrame:
        return null_safe_lookup(rows, catalog.select("sku", *columns), "sku", row_id, matched="w_katalogu", counted=typed)

    return SalesTables(marked, lookup, controls, row_id)


def file_stem(file: Column) -> Column:
    """The name of a file without folder and extension."""
    return F.regexp_extract(F.url_decode(F.regexp_extract(file, "([^/]*)$", 1)), r"^(.*?)(?:\.[^.]*)?$", 1)


@dataclass
class SalesFiles:
    """What :func:`from_files` read: the merge, the records it could not read, one row per file."""

    sales: SalesTables
    unread: DataFrame
    profile: DataFrame


def from_files(
    spark: SparkSession, exports: Sequence[str] | str, catalog: Sequence[str] | str, branch: Column | None = None, row_id: str = "row_id"
) -> SalesFiles:
    """Merge a folder of branch exports, in whatever formats they come, with a catalog file.

    ``branch`` names the branch of a file from its ``source_file``, the file's name by default; a branch may
    come as several files of several formats.  Rows are numbered over all files, so a document that two
    files of a branch share is found, and the row of the first file stays.
    """
    branch = file_stem(F.col(SOURCE_FILE)) if branch is None else branch
    read = read_csv_files(spark, exports, row_id)
    data, controls = [], []
    for table in read.tables:
        cells = [c for c in table.columns if c not in (SOURCE_FILE, row_id)]
        tagged = table.withColumn("oddzial", branch).drop(SOURCE_FILE)
        rows, control = extract_control_totals(tagged, cells[0], cells[-1], row_id, "oddzial")
        data.append(rows)
        controls.append(control)
    # a branch in several formats may declare a total in each
    declared = reduce(DataFrame.unionByName, controls).groupBy("oddzial").agg(
        F.sum("suma_z_pliku").cast("decimal(18,2)").alias("suma_z_pliku"), F.sum("total_rows").alias("total_rows")
    )
    listed = read_csv_files(spark, catalog, row_id)
    products = reduce(DataFrame.unionByName, [typed_catalog(t.drop(SOURCE_FILE, row_id)) for t in listed.tables])
    merged = merge_sales(merge_branches(data, row_id), products, declared, row_id)
    unread = read.rejects.unionByName(listed.rejects)
    return SalesFiles(merged, unread, read.profile.unionByName(listed.profile))
