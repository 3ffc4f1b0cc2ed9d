"""The same results in DuckDB SQL, written independently of the Spark expressions.

Text rules use list lambdas as let-bindings, so that each intermediate has a name.
"""

from __future__ import annotations

from verification import fixtures

ORACLES: dict[str, str] = {}

NUMBERED = "(select *, row_number() over () - 1 as row_id from lineitem)"


def source(text: str) -> str:
    for name in ("customer", "part", "documents", "conversations"):
        text = text.replace("{%s}" % name, name)
    return text.replace("{lineitem}", NUMBERED)


CRM, EXPORT, SALES, CATALOG = map(source, (fixtures.CRM, fixtures.CRM_EXPORT, fixtures.SALES, fixtures.CATALOG))
TEXTS, EXPORTS = source(fixtures.TEXTS), source(fixtures.EXPORTS)


# ---- rules as SQL expressions ---------------------------------------------------------------
_depth = 0


def let(value: str, body) -> str:
    """``body(name)`` with ``name`` bound to ``value``."""
    global _depth
    _depth += 1
    name = f"v{_depth}"
    return f"list_transform([{value}], lambda {name}: {body(name)})[1]"


SPACE = "[\\s\\x0b\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
NOTHING = "('', '-', '--', '?', 'brak', 'n/a', 'na', 'null', 'none', 'nan', 'nat', '<na>')"


def clean(x):
    return let(f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'), ' ')", lambda v: f"case when lower({v}) in {NOTHING} then null else {v} end")


def fold(x):
    return f"strip_accents(translate({x}, 'łŁ', 'lL'))"


def key(x):
    return f"regexp_replace(lower({fold(clean(x))}), '[^a-z0-9]', '', 'g')"


def title(x):
    return f"array_to_string(list_transform(regexp_extract_all({x}, '\\p{{L}}+|\\P{{L}}+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


def person(x):
    return let(f"regexp_replace({clean(x)}, '^(pan|pani|p\\.|dr|mgr|inż\\.?|prof\\.?)\\s+', '', 'i')", lambda v: f"case when {v} is not null then {title(v)} end")


def first_name(x):
    return f"split_part({x}, ' ', 1)"


def rest_name(x):
    return f"case when contains({x}, ' ') then substr({x}, position(' ' in {x}) + 1) end"


CITIES = {"warszawa": "Warszawa", "krakow": "Kraków", "wroclaw": "Wrocław", "poznan": "Poznań", "gdansk": "Gdańsk",
          "lodz": "Łódź", "lublin": "Lublin", "katowice": "Katowice", "wwa": "Warszawa"}


def city(x):
    names = " ".join(f"when '{k}' then '{v}'" for k, v in CITIES.items())
    return f"case {key(x)} {names} else {let(clean(x), lambda v: f'case when {v} is not null then {title(v)} end')} end"


def email(x):
    typos = {"gmial.com": "gmail.com", "gmai.com": "gmail.com", "gmail.pl": "gmail.com", "gmail,com": "gmail.com",
             "wp,pl": "wp.pl", "onet,pl": "onet.pl", "interia,pl": "interia.pl", "o2,pl": "o2.pl"}
    fixes = " ".join(f"when ends_with(v, '@{a}') then substr(v, 1, length(v) - {len(a)}) || '{b}'" for a, b in typos.items())
    fixed = f"list_transform([replace(lower({clean(x)}), ' ', '')], lambda v: case {fixes} else v end)[1]"
    return let(fixed, lambda v: f"case when regexp_full_match({v}, '[a-z0-9._%+-]+@[a-z0-9-]+(\\.[a-z0-9-]+)*\\.[a-z]{{2,}}') then {v} end")


def phone(x):
    digits = f"regexp_replace(regexp_replace({clean(x)}, '\\.0$', ''), '[^0-9]', '', 'g')"
    national = let(digits, lambda v: f"case when length({v}) = 13 and starts_with({v}, '0048') then substr({v}, 5) when length({v}) = 11 and starts_with({v}, '48') then substr({v}, 3) else {v} end")
    return let(national, lambda v: f"case when length({v}) = 9 then '+48 ' || substr({v}, 1, 3) || ' ' || substr({v}, 4, 3) || ' ' || substr({v}, 7, 3) end")


def postal(x):
    raw = f"regexp_replace({clean(x)}, '\\.0$', '')"
    digits = let(raw, lambda v: f"case when regexp_full_match({v}, '[0-9]{{3,4}}') then lpad({v}, 5, '0') else regexp_replace({v}, '[^0-9]', '', 'g') end")
    return let(digits, lambda v: f"case when length({v}) = 5 then left({v}, 2) || '-' || right({v}, 3) end")


def sku(x):
    compact = f"regexp_replace(upper({clean(x)}), '[^A-Z0-9]', '', 'g')"
    return let(compact, lambda v: f"case when regexp_full_match({v}, '[A-Z]+[0-9]+') then "
               f"regexp_extract({v}, '^[A-Z]+') || '-' || list_transform([ltrim(regexp_extract({v}, '[0-9]+$'), '0')], lambda n: lpad(n, cast(greatest(length(n), 3) as integer), '0'))[1] else {v} end")


def number(x):
    bare = f"regexp_replace(regexp_replace({clean(x)}, 'zł|ZŁ|Zł|zŁ|pln|zl', '', 'gi'), '{SPACE}', '', 'g')"

    def point(v):
        commas, dots = f"contains({v}, ',')", f"contains({v}, '.')"
        last_comma = f"position(',' in reverse({v})) < position('.' in reverse({v}))"
        return (f"case when {commas} and {dots} and {last_comma} then replace(replace({v}, '.', ''), ',', '.') "
                f"when {commas} and {dots} then replace({v}, ',', '') when {commas} then replace({v}, ',', '.') "
                f"when length({v}) - length(replace({v}, '.', '')) > 1 then replace({v}, '.', '') else {v} end")

    return let(let(bare, point), lambda v: f"case when {plain(v)} then try_cast({v} as double) end")


def plain(x):
    return f"regexp_full_match({x}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"


def day(x):
    text = f"regexp_replace({clean(x)}, '[ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?$', '')"
    return let(text, lambda v: (
        f"case when regexp_full_match({v}, '[0-9]{{5}}(\\.0)?') then date '1899-12-30' + cast(left({v}, 5) as integer) "
        f"when regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') then cast(try_strptime({v}, '%Y-%m-%d') as date) "
        f"when regexp_full_match({v}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') then cast(try_strptime({v}, '%Y/%m/%d') as date) "
        f"when regexp_full_match({v}, '[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{4}}') then cast(try_strptime(translate({v}, '/-', '..'), '%d.%m.%Y') as date) "
        f"when regexp_full_match({v}, '[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{2}}') then cast(try_strptime(translate({v}, '/-', '..'), '%d.%m.%y') as date) end"))


def cents(x):
    """Rounded to cents, half to even on the scaled double."""
    return f"round_even(({x}) * 100, 0) / 100"


def money(x):
    return f"cast({cents(x)} as decimal(18,2))"


# ---- 2.2 text rules ---------------------------------------------------------------------------
def digest_of(expression: str) -> str:
    return f"select id, md5(o) digest, cast(length(o) as bigint) chars from (select id, {expression} o from ({TEXTS}) t) x"


ORACLES["clean_text"] = digest_of(clean("text"))
ORACLES["strip_accents"] = digest_of(fold("text"))
ORACLES["normalize_key"] = digest_of(key("text"))
ORACLES["column_key"] = digest_of(f"trim(regexp_replace(lower({fold('text')}), '[^a-z0-9]+', '_', 'g'), '_')")
ORACLES["mark_whitespace"] = digest_of(
    "repeat('·', length(text) - length(ltrim(text, ' ')))"
    " || coalesce(array_to_string(list_transform(regexp_extract_all(trim(text, ' '), '(?s) {2,}|[^ ]+| '),"
    " lambda w: case when starts_with(w, '  ') then repeat('·', length(w)) else w end), ''), '')"
    " || case when trim(text, ' ') = '' then '' else repeat('·', length(text) - length(rtrim(text, ' '))) end")
ORACLES["normalize_person_names"] = f"""
select id, raw, {person('raw')} as name from (
 select 'crm-'||row_id id, imie_nazwisko raw from ({CRM}) c
 union all select 'c-'||c_custkey, 'Dr '||c_name||' o''neil' from customer) x"""
ORACLES["split_full_names"] = f"""
select row_id, {first_name('n')} imie, {rest_name('n')} nazwisko from (select row_id, {person('imie_nazwisko')} n from ({CRM}) c) x"""
ORACLES["normalize_cities"] = f"""
select raw, {city('raw')} city, count(*) as rows from (
 select miasto raw from ({CRM}) c union all select '  '||lower(n_name) from nation) x group by raw"""

# ---- 2.3 -----------------------------------------------------------------------------------------
ORACLES["normalize_email"] = f"select row_id, email, {email('email')} as value from ({CRM}) c"
ORACLES["normalize_phone"] = f"select row_id, telefon, {phone('telefon')} as value from ({CRM}) c"
ORACLES["normalize_postal_code"] = f"select row_id, kod_pocztowy, {postal('kod_pocztowy')} as value from ({CRM}) c"
ORACLES["phone_from_number_column"] = f"""select row_id, {phone('n')} phone
 from (select c_custkey row_id, cast(500000000 + cast(floor(abs(c_acctbal) * 100) as bigint) as varchar) n from customer) x"""
ORACLES["normalize_skus"] = f"""
select row_id, {sku('sku')} code from (select row_id, sku from ({SALES}) s union all select p_partkey + 5000000000000, p_brand from part) x"""
ORACLES["parse_number"] = f"""
select row_id, {number('raw')} amount from (select row_id, wartosc_zamowien_pln raw from ({CRM}) c
 union all select row_id + 5000000000000, cena_jedn||' PLN' from ({SALES}) s) x"""
ORACLES["parse_dates"] = f"""
select row_id, cast({day('raw')} as varchar) as day from (select row_id, data_rejestracji raw from ({CRM}) c
 union all select o_orderkey + 5000000000000, day(o_orderdate)||'/'||month(o_orderdate)||'/'||right(cast(year(o_orderdate) as varchar), 2) from orders) x"""
ORACLES["count_text_amounts"] = f"""
select count(*) filter (where not coalesce({plain('trim(wartosc_zamowien_pln)')}, false)) text_amounts, count(*) as rows from ({EXPORT}) e"""
ORACLES["line_value"] = f"select row_id, {cents('l_quantity * l_extendedprice')} as value from {NUMBERED} l"
ORACLES["discount_flag"] = f"""
select row_id, case when l_extendedprice / l_quantity < p_retailprice - 0.005 then 'tak' else 'nie' end discounted
from {NUMBERED} l left join part on l_partkey = p_partkey"""
ORACLES["month_buckets"] = "select strftime(l_shipdate, '%Y-%m') as month, count(*) as rows from lineitem group by 1"
ORACLES["format_locale"] = """
select o_orderkey, translate(format('{:,.2f}', o_totalprice), ',.', ' ,') pl, format('{:,.2f}', o_totalprice) en,
 strftime(o_orderdate, '%Y-%m-%d') as day from orders"""

# ---- columns, filters, lookups -----------------------------------------------------------------------
CUSTOMER_COLUMNS = "id_klienta, imie_nazwisko, email, telefon, miasto, kod_pocztowy, data_rejestracji, wartosc_zamowien_pln"
ORACLES["standardize_columns"] = f"select {CUSTOMER_COLUMNS} from ({CRM}) c"
_ANY_TEXT = "coalesce(" + ", ".join(clean(c) for c in CUSTOMER_COLUMNS.split(", ")) + ") is not null"
ORACLES["drop_blank_rows"] = f"select row_id, id_klienta from ({EXPORT}) e where {_ANY_TEXT}"

TYPED_SALES = f"""
select row_id, oddzial, {clean('nr_transakcji')} nr_transakcji, {day('data')} data, sku sku_raw, {clean('sku')} sku_txt, {sku('sku')} sku,
 case when floor({number('ilosc')}) = {number('ilosc')} then cast({number('ilosc')} as bigint) end ilosc, {number('cena_jedn')} cena_jedn"""
SALE_ROWS = f"{TYPED_SALES} from ({SALES}) s"
TYPED_CATALOG = f"select {sku('sku')} sku, nazwa_produktu, kategoria, {number('cena_katalogowa')} cena_katalogowa from ({CATALOG}) k"

ORACLES["reject_unreadable"] = f"""
select row_id, oddzial, concat_ws(', ', case when data is null then 'data' end, case when ilosc is null then 'ilosc' end,
 case when cena_jedn is null then 'cena_jedn' end) reason
from ({SALE_ROWS}) t where data is null or ilosc is null or cena_jedn is null"""
ORACLES["validate_many_to_one"] = "select p_name, count(*) as rows from part group by p_name having count(*) > 1"
ORACLES["null_safe_lookup"] = """
with d as (select distinct nullif(o_orderpriority, '1-URGENT') p, cast(length(o_orderpriority) as bigint) width from orders),
f as (select o_orderkey, nullif(o_orderpriority, '1-URGENT') || case when o_orderkey % 11 = 0 then '?' else '' end priority from orders)
select o_orderkey, priority, width, width is not null matched from f left join d on priority is not distinct from p"""
ORACLES["enrich_catalog"] = f"""
with t as ({SALE_ROWS}), k as ({TYPED_CATALOG})
select row_id, t.sku, nazwa_produktu, coalesce(kategoria, 'Brak w katalogu') kategoria, cena_katalogowa, k.sku is not null w_katalogu,
 case when cena_jedn < cena_katalogowa - 0.005 then 'tak' else 'nie' end rabat, {cents('ilosc * cena_jedn')} wartosc_brutto,
 strftime(data, '%Y-%m') miesiac
from t left join k on t.sku = k.sku where data is not null and ilosc is not null and cena_jedn is not null"""
ORACLES["unmatched_keys"] = f"select distinct sku from ({SALE_ROWS}) t where sku not in (select sku from ({TYPED_CATALOG}) k)"

# ---- duplicates and linking -------------------------------------------------------------------------------
ORACLES["dedup_exact"] = f"select min(row_id) row_id, count(*) copies, id_klienta from ({EXPORT}) e group by {CUSTOMER_COLUMNS}"
ORACLES["dedup_exact_documents"] = "select min(doc_id) doc_id, count(*) copies, lang from documents group by text, lang"
_RANKED = f"select *, row_number() over (partition by oddzial, nr_transakcji, sku order by row_id) rn from ({SALE_ROWS}) t"
ORACLES["dedup_keep_first"] = f"select row_id, oddzial, nr_transakcji, sku from ({_RANKED}) r where nr_transakcji is null or rn = 1"
ORACLES["removed_repeats"] = f"select row_id, oddzial, nr_transakcji, sku from ({_RANKED}) r where nr_transakcji is not null and rn > 1"

_TYPED_CTE = f"""
rows_in as (select min(row_id) row_id, count(*) copies, {CUSTOMER_COLUMNS} from ({EXPORT}) e group by {CUSTOMER_COLUMNS}),
cleaned as (select *, {', '.join(f"{clean(c)} {c}_txt" for c in CUSTOMER_COLUMNS.split(', '))} from rows_in),
named as (select *, coalesce({', '.join(f"{c}_txt" for c in CUSTOMER_COLUMNS.split(', '))}) is null blank, {person('imie_nazwisko')} full_name,
  {email('email')} f_email, {phone('telefon')} f_phone, {city('miasto')} f_city, {postal('kod_pocztowy')} f_code,
  {day('data_rejestracji')} f_date, {money(number('wartosc_zamowien_pln'))} f_amount from cleaned),
every as (select *, {first_name('full_name')} imie, {rest_name('full_name')} nazwisko,
  lower({first_name('full_name')}) || ' ' || lower({rest_name('full_name')}) match_name from named),
typed as (select * from every where not blank)"""
_LINK_CTE = """
edges as (
  select row_id a, min(row_id) over (partition by f_email) b from typed where f_email is not null
  union select row_id, min(row_id) over (partition by match_name, f_phone) from typed where match_name is not null and f_phone is not null),
both_ways as (select a, b from edges union select b, a from edges),
reach(node, seen) as (select row_id, row_id from typed union select r.node, e.b from reach r join both_ways e on r.seen = e.a),
labels as (select node, min(seen) group_id from reach group by node),
linked as (select t.*, group_id, count(*) over (partition by group_id) group_size from typed t join labels on node = row_id)"""
_FIRST = "arg_min({0}, (coalesce(f_date, date '9999-12-31'), row_id)) filter (where {0} is not null)"
_GOLDEN_CTE = f"""
grouped as (select group_id, {', '.join(f"{_FIRST.format(c)} {n}" for c, n in [
    ('id_klienta_txt', 'id_klienta'), ('imie', 'imie'), ('nazwisko', 'nazwisko'), ('f_email', 'email'), ('f_phone', 'telefon'),
    ('f_city', 'miasto'), ('f_code', 'kod_pocztowy'), ('email_txt', 'raw_email'), ('telefon_txt', 'raw_phone'), ('data_rejestracji_txt', 'raw_date')])},
  min(f_date) data_rejestracji, cast(sum(f_amount) as double) wartosc_zamowien_pln, count(*) liczba_rekordow,
  coalesce(string_agg(id_klienta_txt, ', ' order by id_klienta_txt), '') scalone_id from linked group by group_id),
issues as (select *,
  case when email is null then coalesce('nieprawidłowy e-mail: ''' || raw_email || '''', 'brak: e-mail') end i1,
  case when telefon is null then coalesce('nieprawidłowy telefon: ''' || raw_phone || '''', 'brak: telefon') end i2,
  case when data_rejestracji is null then coalesce('nieprawidłowy data rejestracji: ''' || raw_date || '''', 'brak: data rejestracji') end i3,
  case when not (case miasto when 'Warszawa' then starts_with(kod_pocztowy, '0') when 'Kraków' then left(kod_pocztowy, 2) in ('30','31','32')
    when 'Wrocław' then left(kod_pocztowy, 2) in ('50','51') when 'Poznań' then left(kod_pocztowy, 2) in ('60','61') when 'Gdańsk' then left(kod_pocztowy, 2) = '80'
    when 'Łódź' then left(kod_pocztowy, 2) in ('90','91','92','93','94') when 'Lublin' then left(kod_pocztowy, 2) = '20'
    when 'Katowice' then left(kod_pocztowy, 2) = '40' else true end) then 'kod ' || kod_pocztowy || ' nie pasuje do miasta ' || miasto end i4 from grouped),
golden as (select id_klienta, imie, nazwisko, email, telefon, miasto, kod_pocztowy, cast(data_rejestracji as varchar) data_rejestracji,
  wartosc_zamowien_pln, liczba_rekordow, scalone_id, concat_ws('; ', i1, i2, i3, i4) do_sprawdzenia from issues)"""
TYPED_CTE = f"with recursive {_TYPED_CTE}"
LINK_CTE = f"{TYPED_CTE},{_LINK_CTE}"
GOLDEN_CTE = f"{LINK_CTE},{_GOLDEN_CTE}"

ORACLES["link_records"] = f"{LINK_CTE} select row_id, group_id, group_size from linked"
ORACLES["golden_record"] = f"{GOLDEN_CTE} select * from golden"
ORACLES["merged_ids"] = f"""{LINK_CTE} select group_id, row_number() over (partition by group_id order by id_klienta_txt) - 1 as position, id_klienta_txt id
 from linked where group_size > 1 and id_klienta_txt is not null"""
_LARGE = "select cast(ascii(l_returnflag) as bigint) group_id, 'L' || l_orderkey || '-' || l_linenumber id from lineitem"
ORACLES["membership_of_large_groups"] = f"select group_id, row_number() over (partition by group_id order by id) - 1 as position, id from ({_LARGE}) l"
ORACLES["id_texts_of_large_groups"] = f"""select group_id, md5(string_agg(id, ', ' order by id)) digest, cast(length(string_agg(id, ', ' order by id)) as bigint) chars
 from ({_LARGE}) l group by group_id having count(*) > 10000"""
ORACLES["link_items"] = f"""select row_id, case when chain % 3 = 0 then 0 else chain * 1000 end group_id,
 count(*) over (partition by case when chain % 3 = 0 then 0 else chain * 1000 end) group_size from (select row_id, row_id // 1000 chain from {NUMBERED}) l"""
ORACLES["reject_overflow"] = f"""select row_id, oddzial, concat_ws(', ', case when data is null then 'data' end, case when ilosc is null then 'ilosc' end, case when cena_jedn is null then 'cena_jedn' end,
 case when ilosc * case when row_id % 100 = 7 then cena_jedn * 1e16 else cena_jedn end >= 1e16 then 'wartosc_brutto' end) reason from ({SALE_ROWS}) t
 where data is null or ilosc is null or cena_jedn is null or ilosc * case when row_id % 100 = 7 then cena_jedn * 1e16 else cena_jedn end >= 1e16"""
ORACLES["locale_csv_floats"] = """with n as (select row_id, cast(l_linenumber as varchar) w, rtrim(cast(l_suppkey % 90 + 10 as varchar), '0') f, l_partkey % 60 - 30 e from """ + NUMBERED + """ l),
d as (select row_id, w || f digits, length(w) + e point from n),
t as (select row_id, case when point <= 0 then '0.' || repeat('0', cast(-point as bigint)) || digits when point >= length(digits) then digits || repeat('0', cast(point - length(digits) as bigint)) || '.0'
 else substr(digits, 1, cast(point as bigint)) || '.' || substr(digits, cast(point + 1 as bigint)) end v from d)
select row_id, replace(v, '.', ',') as value from t"""
ORACLES["merged_id_parts"] = f"""{LINK_CTE} select group_id, cast(0 as bigint) part_no, string_agg(id_klienta_txt, ', ' order by id_klienta_txt) record_ids,
 count(id_klienta_txt) ids from linked where group_size > 1 and id_klienta_txt is not null group by group_id"""
ORACLES["record_issues"] = f"""{GOLDEN_CTE}
select id_klienta, 'email' as rule, i1 issue from issues where i1 is not null
union all select id_klienta, 'telefon', i2 from issues where i2 is not null
union all select id_klienta, 'data_rejestracji', i3 from issues where i3 is not null
union all select id_klienta, 'kod_pocztowy', i4 from issues where i4 is not null"""
ORACLES["city_postal_mismatch"] = f"""{TYPED_CTE} select row_id, f_city miasto, f_code kod_pocztowy from typed
where f_code is not null and not (case f_city when 'Warszawa' then f_code like '0%' when 'Kraków' then regexp_matches(f_code, '^3[012]')
 when 'Wrocław' then regexp_matches(f_code, '^5[01]') when 'Poznań' then regexp_matches(f_code, '^6[01]') when 'Gdańsk' then f_code like '80%'
 when 'Łódź' then regexp_matches(f_code, '^9[0-4]') when 'Lublin' then f_code like '20%' when 'Katowice' then f_code like '40%' else true end)"""
ORACLES["review_queue"] = f"{GOLDEN_CTE} select * from golden where do_sprawdzenia <> ''"
ORACLES["merged_customers"] = f"""{GOLDEN_CTE} select id_klienta, imie, nazwisko, email, liczba_rekordow, scalone_id, wartosc_zamowien_pln
from golden where liczba_rekordow > 1"""
ORACLES["clean_customers"] = f"{GOLDEN_CTE} select * exclude (scalone_id) from golden"

_CHANGED = {
    "names": "imie_nazwisko is distinct from full_name", "emails": "email_txt is distinct from f_email", "phones": "telefon_txt is distinct from f_phone",
    "cities": "miasto is distinct from f_city", "postal_codes": "kod_pocztowy_txt is distinct from f_code",
}
ORACLES["count_changed"] = f"{TYPED_CTE} select {', '.join(f'count(*) filter (where {c}) {n}' for n, c in _CHANGED.items())} from typed"
_LOG = [
    ("Wiersze w pliku wejściowym", "rows", "(select sum(copies) from every)"),
    ("Usunięte puste wiersze", "removed", "(select coalesce(sum(copies), 0) from every where blank)"),
    ("Usunięte identyczne wiersze (wklejone dwa razy)", "removed", "(select sum(copies - 1) from typed)"),
    ("Poprawione imiona i nazwiska (wielkość liter, spacje, tytuły)", "standardized", f"(select count(*) from typed where {_CHANGED['names']})"),
    ("Ujednolicone adresy e-mail", "standardized", f"(select count(*) from typed where {_CHANGED['emails']})"),
    ("Telefony sprowadzone do formatu +48 XXX XXX XXX", "standardized", f"(select count(*) from typed where {_CHANGED['phones']})"),
    ("Ujednolicone nazwy miast", "standardized", f"(select count(*) from typed where {_CHANGED['cities']})"),
    ("Poprawione kody pocztowe (w tym utracone zera z Excela)", "standardized", f"(select count(*) from typed where {_CHANGED['postal_codes']})"),
    ("Daty z różnych formatów zamienione na RRRR-MM-DD", "standardized", "(select count(f_date) from typed)"),
    ("Kwoty tekstowe (''1 234,50 zł'') zamienione na liczby", "standardized",
     f"(select count(*) from typed where not coalesce({plain('trim(wartosc_zamowien_pln)')}, false))"),
    ("Scalone duplikaty klientów (ten sam e-mail lub imię+nazwisko+telefon)", "merged", "(select count(*) from typed) - (select count(*) from golden)"),
    ("Klienci w wyniku końcowym", "rows", "(select count(*) from golden)"),
    ("Rekordy oznaczone do ręcznej weryfikacji", "flagged", "(select count(*) from golden where do_sprawdzenia <> '')"),
]
_LOG_ROWS = " union all ".join(
    f"select cast({i} as bigint) step_no, '{name}' step, '{kind}' category, cast({count} as bigint) as count" for i, (name, kind, count) in enumerate(_LOG, 1))
ORACLES["change_log"] = f"{GOLDEN_CTE} {_LOG_ROWS}"
ORACLES["headline_stats"] = f"""{GOLDEN_CTE}, log as ({_LOG_ROWS})
select max(count) filter (where step_no = 1) rows_in, max(count) filter (where step_no = 12) customers, max(count) filter (where step_no = 11) merged,
 cast(sum(count) filter (where step_no between 4 and 10) as bigint) standardized, max(count) filter (where step_no = 13) to_verify from log"""

_RAW = CUSTOMER_COLUMNS.split(", ")
_MESS = " + ".join(f"cast(coalesce({c}, '') <> coalesce({c}_txt, '') as bigint)" for c in _RAW)
ORACLES["messiest_rows"] = f"""{TYPED_CTE} select row_id, {_MESS} score, {', '.join(f'{c} raw_{c}' for c in _RAW)} from typed
order by score desc, row_id limit 6"""
_FLAGS = {
    "imie_nazwisko": "coalesce(imie_nazwisko, '') <> coalesce(imie || ' ' || nazwisko, '')",
    "email": "coalesce(email, '') <> coalesce(f_email, '')",
    "telefon": "coalesce(telefon, '') <> coalesce(f_phone, '')",
    "miasto": "coalesce(miasto, '') <> coalesce(f_city, '')",
    "kod_pocztowy": "coalesce(kod_pocztowy, '') <> coalesce(f_code, '')",
    "data_rejestracji": "coalesce(data_rejestracji, '') <> coalesce(cast(f_date as varchar), '')",
    "wartosc_zamowien_pln": "coalesce(wartosc_zamowien_pln, '') <> coalesce(cast(f_amount as varchar), '') and not coalesce("
                            f"{plain('trim(wartosc_zamowien_pln)')} and {cents('try_cast(wartosc_zamowien_pln as double)')} = cast(f_amount as double), false)",
}
_WHOLE = " and ".join(f"{c} is not null" for c in ("imie", "nazwisko", "f_email", "f_phone", "f_city", "f_code", "f_date", "f_amount"))
ORACLES["repaired_rows"] = f"""{TYPED_CTE}, flagged as (select *, {', '.join(f'{c} changed_{n}' for n, c in _FLAGS.items())} from typed)
select row_id, case when {_WHOLE} then {' + '.join(f'cast(changed_{n} as bigint)' for n in _FLAGS)} else -1 end score, imie, nazwisko, f_email email,
 f_phone telefon, f_city miasto, f_code kod_pocztowy, cast(f_date as varchar) data_rejestracji, cast(f_amount as double) wartosc_zamowien_pln,
 {', '.join(f'changed_{n}' for n in _FLAGS)} from flagged order by score desc, row_id limit 6"""

# ---- the merged sales table -----------------------------------------------------------------------------------
_IS_TOTAL = f"coalesce(upper({clean('data')}) in ('RAZEM', 'SUMA', 'TOTAL'), false)"
_SALES_CTE = f"""with exports as ({EXPORTS}),
controls as (select oddzial, {money(number('wartosc'))} suma_z_pliku, cast(1 as bigint) total_rows from exports where {_IS_TOTAL}),
loaded as ({TYPED_SALES} from exports where not {_IS_TOTAL}),
marked as (select *, nr_transakcji is not null and row_number() over (partition by oddzial, nr_transakcji, sku order by row_id) > 1 is_repeat from loaded),
catalog as ({TYPED_CATALOG}),
sold as (select m.*, nazwa_produktu, coalesce(kategoria, 'Brak w katalogu') kategoria, cena_katalogowa, k.sku is not null w_katalogu,
  case when cena_jedn < cena_katalogowa - 0.005 then 'tak' else 'nie' end rabat, {money('ilosc * cena_jedn')} wartosc_brutto, strftime(data, '%Y-%m') miesiac
  from marked m left join catalog k on m.sku = k.sku where not is_repeat and data is not null and ilosc is not null and cena_jedn is not null)"""


def pivot(column: str, total: bool) -> str:
    cells = ", ".join(f"cast(sum(wartosc_brutto) filter (where oddzial = '{b}') as double) \"{b}\"" for b in "ABC")
    if not total:
        return f"{_SALES_CTE} select {column}, {cells} from sold group by {column}"
    return (f"{_SALES_CTE} select case when grouping({column}) = 1 then 'RAZEM' else {column} end {column}, {cells}, "
            f'cast(sum(wartosc_brutto) as double) "RAZEM" from sold group by rollup ({column})')


ORACLES["pivot_with_totals"] = pivot("miesiac", True)
ORACLES["category_pivot"] = pivot("kategoria", True)
ORACLES["monthly_pivot"] = pivot("miesiac", False)
ORACLES["top_products"] = f"""{_SALES_CTE} select sku, nazwa_produktu, cast(sum(ilosc) as bigint) sprzedane_szt, cast(sum(wartosc_brutto) as double) przychod
from sold group by sku, nazwa_produktu order by przychod desc, sku, nazwa_produktu limit 10"""
ORACLES["unmatched_summary"] = f"""{_SALES_CTE} select oddzial, sku, count(*) transakcje, cast(sum(wartosc_brutto) as double) wartosc
from sold where not w_katalogu group by oddzial, sku"""
_CHECKS = """select oddzial, suma_z_pliku, (select coalesce(sum(wartosc_brutto), 0) from sold where sold.oddzial = controls.oddzial) suma_po_scaleniu from controls"""
_APART = f"""select oddzial, sum({money('ilosc * cena_jedn')}) filter (where is_repeat) repeated,
 sum({money('ilosc * cena_jedn')}) filter (where not is_repeat and (data is null or ilosc is null or cena_jedn is null)) rejected from marked group by oddzial"""
ORACLES["reconcile_totals"] = f"""{_SALES_CTE} select oddzial, cast(suma_z_pliku as double) suma_z_pliku, cast(suma_po_scaleniu as double) suma_po_scaleniu,
 cast(coalesce(repeated, 0) as double) kwota_powtorek, cast(coalesce(rejected, 0) as double) kwota_odrzuconych,
 case when abs(suma_z_pliku - suma_po_scaleniu) < 0.01 then 'TAK' else 'NIE' end zgodne from ({_CHECKS}) checks left join ({_APART}) apart using (oddzial)"""
ORACLES["control_difference"] = f"{_SALES_CTE} select cast(coalesce(sum(abs(suma_z_pliku - suma_po_scaleniu)), 0) as double) control_difference from ({_CHECKS}) checks"
_SAMPLE_ORDER = "row_number() over (partition by oddzial order by data, row_id)"
ORACLES["sample_per_branch"] = f"""{_SALES_CTE}, pool as (select *, case oddzial when 'C' then 2 else 1 end n, coalesce(sku_raw, '') <> sku messy from sold where w_katalogu),
sized as (select *, count(*) filter (where messy) over (partition by oddzial) >= n enough from pool),
chosen as (select *, {_SAMPLE_ORDER} rn from sized where messy or not enough)
select cast(data as varchar) as data, oddzial, nr_transakcji, sku_raw, sku, nazwa_produktu, ilosc, cena_jedn, cast(wartosc_brutto as double) wartosc_brutto from chosen where rn <= n"""
ORACLES["merged_sales"] = f"""{_SALES_CTE} select cast(data as varchar) as data, miesiac, oddzial, nr_transakcji, sku, nazwa_produktu, kategoria, ilosc, cena_jedn,
 cena_katalogowa, rabat, cast(wartosc_brutto as double) wartosc_brutto from sold"""
ORACLES["sales_log"] = f"""{_SALES_CTE}
select oddzial||': usunięty wiersz podsumowania (RAZEM)' step, 'removed' category, total_rows as count from controls
union all select oddzial||': wczytane transakcje', 'rows', count(*) from marked group by oddzial
union all select oddzial||': ujednolicone kody SKU', 'standardized', count(*) from marked where coalesce(sku_txt, '') <> coalesce(sku, '') group by oddzial
union all select 'Usunięte zdublowane transakcje (ten sam nr dokumentu wyeksportowany 2x)', 'removed', count(*) from marked where is_repeat
union all select 'Wiersze z nieczytelną datą/ilością/ceną', 'removed', count(*) from marked where not is_repeat and (data is null or ilosc is null or cena_jedn is null)
union all select 'Transakcje bez dopasowania w katalogu (do wyjaśnienia z klientem)', 'flagged', count(*) from sold where not w_katalogu
union all select 'Transakcje w pliku wynikowym', 'rows', count(*) from sold"""
ORACLES["control_totals"] = f"{_SALES_CTE} select oddzial, cast(suma_z_pliku as double) suma_z_pliku, total_rows from controls"
ORACLES["merge_branches"] = f"{_SALES_CTE} select row_id, oddzial, nr_transakcji, cast(data as varchar) as data, sku_raw, sku, ilosc, cena_jedn from loaded"

# ---- files --------------------------------------------------------------------------------------------------------
ORACLES["ingest_encoding_profile"] = f"""select oddzial export, case oddzial when 'A' then 'utf-8' when 'B' then 'windows-1250' else 'iso-8859-2' end as "encoding",
 count(*) as rows from ({SALES}) s group by oddzial"""
ORACLES["ingest_separator_profile"] = f"""select distinct oddzial export, case oddzial when 'A' then ',' when 'B' then ';' else chr(9) end separator,
 cast(case oddzial when 'A' then 5 when 'B' then 4 else 6 end as bigint) fields from ({SALES}) s"""
_SALE_CELLS = f"select oddzial, nr_transakcji, cast(data as varchar) as data, sku, ilosc, cena_jedn from ({SALE_ROWS}) t"
ORACLES["ingest_mixed_csv"] = _SALE_CELLS + " where oddzial <> 'A' or row_id % 50 <> 3"
ORACLES["ingest_grid"] = _SALE_CELLS
_NOTE = """case row_id % 7 when 0 then '"said ""hi"";' || chr(10) || 'then, left' || chr(10) || '"' when 1 then '5" pipe' else '' end"""
_EVEN = "coalesce(nr_transakcji, '') || ';' || data || ';' || sku || ';' || ilosc || ';' || cena_jedn"
_ODD = "sku || ',' || data || ',' || coalesce(nr_transakcji, '') || ',' || ilosc || ',\"' || cena_jedn || '\",' || " + _NOTE
ORACLES["ingest_rejects"] = f"""select 'A' as export, case when row_id % 2 = 0 then {_EVEN} || case when row_id % 50 = 3 then ';note;LOST' else '' end
 else {_ODD} || case when row_id % 50 = 3 then ',note,LOST' else '' end end record,
 cast(case when row_id % 50 = 3 then 7 else 5 end + row_id % 2 as bigint) cells, cast(6 + row_id % 2 as bigint) as "columns",
 case when row_id % 50 = 3 then 'surplus' else 'short' end reason, row_id % 50 = 4 as kept
 from ({SALES}) s where oddzial = 'A' and row_id % 50 in (3, 4)"""
ORACLES["ingest_row_ids"] = f"""select oddzial, count(*) as rows, cast(0 as bigint) late_files, count(*) ids from ({SALES}) s
 where oddzial <> 'A' or row_id % 50 <> 3 group by oddzial"""
ORACLES["sales_job_from_files"] = ORACLES["merged_sales"]
ORACLES["sales_checks_from_files"] = ORACLES["reconcile_totals"]
ORACLES["customers_from_files"] = ORACLES["clean_customers"]
ORACLES["detect_header_rows"] = f"""select distinct oddzial source_file, cast(-1 as bigint) header_row, 'Nr paragonu' c0, 'Data sprzedaży' c1, 'SKU' c2, 'Szt.' c3,
 'Cena brutto' c4 from ({SALES}) s"""
ORACLES["locale_csv"] = f"""select cast(row_id as varchar) row_id, oddzial, cast(data as varchar) as data, sku, cast(ilosc as varchar) ilosc,
 replace(cast(cena_jedn as varchar), '.', ',') cena_jedn, replace(cast({money('ilosc * cena_jedn')} as varchar), '.', ',') wartosc_brutto
from ({SALE_ROWS}) t where data is not null and ilosc is not null and cena_jedn is not null"""
ORACLES["report_manifest"] = f"""{_SALES_CTE}, t(name, rows, columns) as (
 select 'dane', count(*), 12 from sold
 union all select 'miesiace_x_oddzialy', count(distinct miesiac) + 1, 5 from sold
 union all select 'kategorie', count(distinct kategoria) + 1, 5 from sold
 union all select 'top10_produktow', least(10, count(distinct (sku, nazwa_produktu))), 4 from sold
 union all select 'brak_w_katalogu', count(distinct (oddzial, sku)), 4 from sold where not w_katalogu
 union all select 'sumy_kontrolne', count(*), 6 from controls
 union all select 'odrzucone', count(*), 8 from marked where not is_repeat and (data is null or ilosc is null or cena_jedn is null)
 union all select 'zdublowane', count(*), 7 from marked where is_repeat
 union all select 'log_zmian', 4 + (select count(*) from controls) + count(distinct oddzial) + count(distinct oddzial) filter (where coalesce(sku_txt, '') <> coalesce(sku, '')), 4 from marked)
select name, cast(rows as bigint) as rows, cast(columns as bigint) as columns from t"""
_BUNDLES = {
    "klienci": "clean_customers", "scalone_duplikaty": "merged_customers", "do_weryfikacji": "review_queue", "log_zmian": "change_log",
}
ORACLES["delivered_order"] = f"select 'sales' as bundle, name, rows, true in_order from ({ORACLES['report_manifest']}) m where name <> 'top10_produktow'" + "".join(
    f" union all select 'customers', '{name}', (select count(*) from ({ORACLES[query]}) t), true" for name, query in _BUNDLES.items()
)
ORACLES["sales_headline"] = f"""{_SALES_CTE} select (select count(*) from marked) rows_in, (select count(*) from sold) sales,
 (select count(*) from marked where coalesce(sku_txt, '') <> coalesce(sku, '')) fixed_skus, (select count(*) from marked where is_repeat) repeats,
 (select count(*) from marked where not is_repeat and (data is null or ilosc is null or cena_jedn is null)) rejects,
 (select count(*) from sold where not w_katalogu) unmatched, (select cast(sum(wartosc_brutto) as double) from sold) revenue,
 (select control_difference from ({ORACLES['control_difference']}) c) control_difference"""
