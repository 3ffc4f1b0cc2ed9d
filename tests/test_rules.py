"""Value tables for every rule, including the notations that trip engines up."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sparktidy import (
    apply_rules,
    clean_text,
    column_key,
    mark_whitespace,
    normalize_city,
    normalize_email,
    normalize_key,
    normalize_person_name,
    normalize_phone_pl,
    normalize_postal_code_pl,
    normalize_sku,
    parse_mixed_dates,
    parse_pl_number,
    split_full_name,
    strip_accents,
)
from sparktidy.functions.numbers import discount_flag, is_plain_number, number_rule, to_money
from sparktidy.functions.render import format_amount, plain_text
from sparktidy.functions.text import header_key

CASES = {
    clean_text: [
        ("  Jan   Kowalski ", "Jan Kowalski"), ("brak", None), ("-", None), ("", None), (None, None), ("ok", "ok"),
        ("a  b", "a b"), ("a b", "a b"), (" x\t\ny　", "x y"), ("BRAK", None), (" n/A ", None),
        ("<NA>", None), ("a   b", "a b"), ("a\x1fb", "a b"),
    ],
    normalize_key: [
        ("Łódź", "lodz"), ("LODZ ", "lodz"), ("łódź!", "lodz"), ("!!", ""), ("brak", None), (None, None), ("ﬁn ½", "fin12"),
        ("Poz. №5", "pozno5"), ("Marka™", "markatm"), ("Ⅳ…", "iv"), ("𝐀b", "ab"), ("ǆ㎏", "dzkg"),
    ],
    strip_accents: [
        ("Zażółć gęślą jaźń Łódź", "Zazolc gesla jazn Lodz"), ("é", "e"), ("ﬃ", "ffi"), ("ø", "ø"), ("Ａ", "A"), (None, None),
        ("ẛ̣", "s"), ("a…½ł", "a...1⁄2l"), ("№ ™ Ⅳ ǆ 𝟗", "No TM IV dz 9"),
    ],
    normalize_person_name: [
        ("  pani ANNA   kowalska-NOWAK ", "Anna Kowalska-Nowak"), ("dr jan nowak", "Jan Nowak"), ("INŻ. ŁUKASZ ŻAK", "Łukasz Żak"),
        ("p. o'neil", "O'Neil"), ("dr mgr jan", "Mgr Jan"), ("abc1def", "Abc1Def"), ("pan", "Pan"), (None, None), ("prof ewa", "Ewa"),
    ],
    normalize_email: [
        (" Jan.Kowalski@GMAIL.com ", "jan.kowalski@gmail.com"), ("anna@gmial.com", "anna@gmail.com"), ("ewa@wp,pl", "ewa@wp.pl"),
        ("jan.kowalskigmail.com", None), ("brak", None), ("a@b@gmai.com", None), ("j a n@o2,pl", "jan@o2.pl"), ("x@y.c", None),
        ("x@gmail.pl", "x@gmail.com"), (None, None), ("@wp,pl", None),
    ],
    normalize_phone_pl: [
        *[(raw, "+48 123 456 789") for raw in (
            "123456789", "123-456-789", "+48 123 456 789", "0048123456789", "(48) 123 456 789", "123456789.0")],
        ("12345", None), ("brak", None), ("49123456789", None), ("00481234567890", None), (None, None),
    ],
    normalize_postal_code_pl: [
        ("00950", "00-950"), ("00-950", "00-950"), ("950", "00-950"), ("1234567", None), ("00-95", None), ("34500.0", "34-500"),
        ("950.0", "00-950"), ("12", None), ("x", None), (None, None),
    ],
    normalize_sku: [
        ("kaw001 ", "KAW-001"), ("KAW 001", "KAW-001"), (" KAW-001", "KAW-001"), ("kaw1", "KAW-001"), ("kaw12345", "KAW-12345"),
        ("KAW00012345", "KAW-12345"), ("KAW000", "KAW-000"), ("12AB", "12AB"), ("A1B2", "A1B2"), ("-", None), (None, None), ("żółw", "W"),
    ],
    parse_pl_number: [
        ("1 234,50 zł", 1234.5), ("PLN 1.234,50", 1234.5), ("1234.5", 1234.5), ("1,234.50", 1234.5), ("99,99", 99.99),
        ("1.234.567", 1234567.0), ("abc", None), ("brak", None), ("1 234,50 zł", 1234.5), ("5 ZŁ", 5.0), ("1d", None),
        ("0x1p3", None), ("1e3", 1000.0), ("-7", -7.0), (".5", 0.5), ("1,2,3", None), ("inf", None), ("1_000", None), (None, None), ("1.2,3.4", None),
    ],
    parse_mixed_dates: [
        *[(raw, date(2024, 3, 5)) for raw in (
            "2024-03-05", "05.03.2024", "5/3/2024", "05.03.24", "45356", "2024-03-05 00:00:00", "2024/3/5", "5-3-2024", "45356.0",
            "2024-03-05T10:30")],
        ("31.02.2023", None), ("jutro", None), ("05.03.99", date(1999, 3, 5)), ("05.03.68", date(2068, 3, 5)),
        ("05.03.69", date(1969, 3, 5)), ("2024-13-01", None), ("0000-01-01", None), ("2024", None), (None, None), ("brak", None), ("00000", date(1899, 12, 30)),
    ],
    normalize_city: [
        ("W-wa", "Warszawa"), ("KRAKOW", "Kraków"), (" łódź ", "Łódź"), ("zakopane", "Zakopane"), ("nowy SĄCZ", "Nowy Sącz"), ("brak", None), (None, None),
    ],
    mark_whitespace: [
        ("  a  b ", "··a··b·"), ("a b", "a b"), ("   ", "···"), (" ", "·"), ("", ""), (None, None), ("a   b c", "a···b c"),
    ],
    column_key: [(" Kod poczt. ", "kod_poczt"), ("E-MAIL", "e_mail"), ("Wartość zamówień (PLN)", "wartosc_zamowien_pln")],
    is_plain_number: [("12.5", True), ("1 234,50 zł", False), (None, False), ("1e3", True), ("", False)],
}


@pytest.mark.parametrize("rule", CASES, ids=lambda r: getattr(r, "name", getattr(r, "__name__", str(r))))
def test_values(values, rule):
    cases = CASES[rule]
    found = values(rule, [raw for raw, _ in cases])
    assert dict(zip([r for r, _ in cases], found)) == dict(cases)


def test_staged_application_equals_composition(spark):
    raws = sorted({raw for cases in CASES.values() for raw, _ in cases if raw is not None}) + [None]
    df = spark.createDataFrame([(r,) for r in raws], "v string")
    rules = [r for r in CASES if hasattr(r, "steps")]
    staged = apply_rules(df, {r.name: (r, "v") for r in rules}, keep=["v"])
    composed = df.select("v", *[r("v").alias(r.name) for r in rules])
    assert staged.exceptAll(composed).isEmpty() and composed.exceptAll(staged).isEmpty()


def test_rules_are_one_codegen_stage_without_python(spark):
    df = spark.range(10).selectExpr("cast(id as string) v")
    rules = [normalize_email, normalize_phone_pl, parse_pl_number, parse_mixed_dates, normalize_key, normalize_sku]
    plan = apply_rules(df, {r.name: (r, "v") for r in rules})._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    )
    assert "Found 1 WholeStageCodegen subtrees" in plan
    assert "Python" not in plan


def test_split_full_name(spark):
    df = spark.createDataFrame([("Anna Maria Nowak",), ("Anna",), (None,)], "v string")
    rows = df.select(*split_full_name("v")).collect()
    assert [tuple(r) for r in rows] == [("Anna", "Maria Nowak"), ("Anna", None), (None, None)]


def test_header_key_matches_column_rule(values):
    names = [" Kod poczt. ", "Wartość zamówień (PLN)", "Ilość", "__x__", "Nr  paragonu", "Stan №2 / ½ szt.™"]
    assert values(column_key, names) == [header_key(n) for n in names]


def test_after_rejects_a_foreign_prefix():
    with pytest.raises(ValueError):
        normalize_email.after(normalize_key)


def test_money_rounds_half_even_on_the_scaled_double(values):
    got = [str(v) for v in values(to_money, [0.125, 1.005, 2.675, 19.999, -0.005], "double")]
    assert got == ["0.12", "1.00", "2.68", "20.00", "0.00"]
    assert values(to_money, [None, 1e300], "double") == [None, None]


def test_discount_without_list_price_is_no(spark):
    df = spark.createDataFrame([(10.0, 12.0), (12.0, 12.0), (11.996, 12.0), (10.0, None), (None, 1.0)], "p double, l double")
    assert [r[0] for r in df.select(discount_flag(F.col("p"), F.col("l"))).collect()] == ["tak", "nie", "nie", "nie", "nie"]


def test_renderings(values):
    assert values(lambda c: format_amount(c, "pl"), [1234567.891, None], "double") == ["1 234 567,89", None]
    assert values(lambda c: format_amount(c, "en", 0), [1234567.5], "double") == ["1,234,568"]
    assert values(lambda c: plain_text(c, "double"), [667063296.0, 1.5, None], "double") == ["667063296", "1.5", None]


def test_phone_from_a_number_column(values):
    phone = lambda c: normalize_phone_pl(plain_text(c, "double"))
    assert values(phone, [667063296.0], "double") == ["+48 667 063 296"]


def test_control_characters_do_not_make_contacts_valid(values):
    assert values(normalize_email, ["a@wp.pl\x01", "a@gmial.com", "a@gmial.com\x01"]) == [None, "a@gmail.com", None]


def test_currency_words_are_literal(values):
    assert values(number_rule(("$", "kr.")), ["$ 5,50", "7 kr.", "7 krx"]) == [5.5, 7.0, None]
