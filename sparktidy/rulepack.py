"""Default rule pack: Polish business data.

Every value here is only a default; the operators take all of them as parameters.
"""

# ---- fixed values -----------------------------------------------------------
PLACEHOLDERS = ("", "-", "--", "?", "brak", "n/a", "na", "null", "none", "nan", "nat", "<na>")

# words a CSV reader treats as missing before any cleaning takes place
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

PERSON_TITLES = ("pan", "pani", "p\\.", "dr", "mgr", "inż\\.?", "prof\\.?")

EMAIL_PATTERN = "^[a-z0-9._%+-]+@[a-z0-9-]+(\\.[a-z0-9-]+)*\\.[a-z]{2,}$"
EMAIL_DOMAIN_TYPOS = {
    "gmial.com": "gmail.com",
    "gmai.com": "gmail.com",
    "gmail.pl": "gmail.com",
    "gmail,com": "gmail.com",
    "wp,pl": "wp.pl",
    "onet,pl": "onet.pl",
    "interia,pl": "interia.pl",
    "o2,pl": "o2.pl",
}

CURRENCY_WORDS = ("zł", "pln", "zl")

CITY_ALIASES = {"wwa": "Warszawa", "w-wa": "Warszawa"}
CITY_POSTAL_PREFIXES = {
    "Warszawa": ("0",),
    "Kraków": ("30", "31", "32"),
    "Wrocław": ("50", "51"),
    "Poznań": ("60", "61"),
    "Gdańsk": ("80",),
    "Łódź": ("90", "91", "92", "93", "94"),
    "Lublin": ("20",),
    "Katowice": ("40",),
}

TOTAL_LABELS = ("RAZEM", "SUMA", "TOTAL")
MARGIN_LABEL = "RAZEM"
NOT_IN_CATALOG = "Brak w katalogu"
YES, NO = "tak", "nie"
AGREES, DIFFERS = "TAK", "NIE"

CUSTOMER_HEADERS = {
    "id_klienta": ["id klienta", "id"],
    "imie_nazwisko": ["imię i nazwisko", "klient", "nazwa"],
    "email": ["e-mail", "mail", "adres e-mail"],
    "telefon": ["tel.", "tel", "nr telefonu"],
    "miasto": ["miejscowość"],
    "kod_pocztowy": ["kod poczt.", "kod"],
    "data_rejestracji": ["data rej.", "data rejestracji"],
    "wartosc_zamowien_pln": ["wartość zamówień (pln)", "wartość zamówień"],
}
SALE_HEADERS = {
    "nr_transakcji": ["order_id", "nr paragonu", "nr dokumentu"],
    "data": ["order_date", "data sprzedaży", "data"],
    "sku": ["kod produktu", "sku", "indeks"],
    "ilosc": ["quantity", "ilość", "szt.", "szt"],
    "cena_jedn": ["unit_price", "cena jedn.", "cena brutto", "cena"],
}
CATALOG_HEADERS = {
    "sku": [],
    "nazwa_produktu": ["nazwa produktu"],
    "kategoria": [],
    "cena_katalogowa": ["cena katalogowa"],
}
# ---- end of fixed values ----------------------------------------------------
