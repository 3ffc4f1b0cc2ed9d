"""Messy inputs derived from the provided tables, as SQL that Spark and DuckDB both run.

Deterministic, without random numbers, over whole tables.  Names in braces stand for the tables;
``{lineitem}`` comes with a ``row_id`` in file order, which each engine numbers in its own way.
"""

CRM = """
with b as (select c_custkey k, c_custkey - case when c_custkey % 10 > 7 then c_custkey % 10 - 7 else 0 end p from {customer}),
c as (select k, p,
 case p % 4 when 0 then 'Łukasz' when 1 then 'Zofia' when 2 then 'Anna' else 'Michał' end fn,
 case p % 3 when 0 then 'Kowalska-Nowak' when 1 then 'Wójcik' else 'Żak' end ln,
 'user'||cast(p as string) loc, cast(500000000 + (p * 7919) % 400000000 as string) ph,
 cast(p % 1000 + (k - p) * 30 as int) off, date '2021-01-01' + cast(p % 1000 + (k - p) * 30 as int) d,
 cast((k * 7919) % 8000 as string) zl, right('0'||cast((k * 13) % 100 as string),2) gr from b)
select k row_id, 'K'||right('000000'||cast(k as string),6) id_klienta,
 case k % 5 when 0 then fn||' '||ln when 1 then upper(fn||' '||ln) when 2 then '  '||fn||'   '||ln||' ' when 3 then 'pani '||fn||' '||ln else lower(fn||' '||ln) end imie_nazwisko,
 case when k % 10 = 9 then loc||'wp.pl' when k % 10 < 7 and k % 11 = 5 then 'brak' when k % 4 = 0 then loc||'@wp.pl' when k % 4 = 1 then upper(loc||'@wp.pl') when k % 4 = 2 then ' '||loc||'@wp.pl  ' else loc||'@wp,pl' end email,
 case when k % 10 = 8 or (k % 10 < 7 and k % 13 = 6) then substr(ph,1,5) when k % 6 = 0 then ph when k % 6 = 1 then substr(ph,1,3)||'-'||substr(ph,4,3)||'-'||substr(ph,7,3) when k % 6 = 2 then '+48 '||substr(ph,1,3)||' '||substr(ph,4,3)||' '||substr(ph,7,3) when k % 6 = 3 then '0048'||ph when k % 6 = 4 then '(48) '||ph else ph||'.0' end telefon,
 case p % 5 when 0 then 'W-wa' when 1 then 'KRAKOW' when 2 then ' łódź ' when 3 then 'Gdansk' else 'zakopane' end miasto,
 case p % 5 when 0 then case when k % 2 = 0 then '950' else '00-950' end when 1 then '30063' when 2 then '90-001' when 3 then case when k % 3 = 0 then '60-101' else '80-101' end else '34500.0' end kod_pocztowy,
 case k % 7 when 0 then cast(d as string) when 1 then right('0'||cast(day(d) as string),2)||'.'||right('0'||cast(month(d) as string),2)||'.'||cast(year(d) as string) when 2 then cast(day(d) as string)||'/'||cast(month(d) as string)||'/'||cast(year(d) as string) when 3 then right('0'||cast(day(d) as string),2)||'.'||right('0'||cast(month(d) as string),2)||'.'||right(cast(year(d) as string),2) when 4 then cast(44197 + off as string) when 5 then cast(d as string)||' 00:00:00' else '31.02.2023' end data_rejestracji,
 case k % 5 when 0 then zl||'.'||gr when 1 then zl||','||gr||' zł' when 2 then 'PLN '||zl||'.'||gr when 3 then '1.'||right('000'||zl,3)||','||gr else 'brak' end wartosc_zamowien_pln
from c
"""

# a second row for every customer: pasted again unchanged for some, nothing but placeholders for the others
CRM_EXPORT = """
select * from ({CRM}) crm
union all select row_id + 1000000000000,
 case when row_id % 10 = 3 then id_klienta end,
 case when row_id % 10 = 3 then imie_nazwisko when row_id % 2 = 0 then ' - ' else '' end,
 case when row_id % 10 = 3 then email end,
 case when row_id % 10 = 3 then telefon when row_id % 3 = 0 then 'brak' end,
 case when row_id % 10 = 3 then miasto end,
 case when row_id % 10 = 3 then kod_pocztowy else '' end,
 case when row_id % 10 = 3 then data_rejestracji end,
 case when row_id % 10 = 3 then wartosc_zamowien_pln else 'n/a' end
 from ({CRM}) crm
""".replace("{CRM}", CRM)

# line items as branch sales; the sales of one month were exported twice
_SALE = """
 case l_suppkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end oddzial,
 case when l_suppkey % 3 = 1 then cast(null as string) else 'R'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string) end nr_transakcji,
 cast(cast(l_shipdate as date) as string) data,
 case l_linenumber % 4 when 1 then 'kaw' when 2 then 'KAW ' when 3 then ' KAW-' else 'KAW-' end
 ||case when l_partkey % 20 = 0 then '9' else '' end
 ||case when l_linenumber % 2 = 0 and l_partkey < 10 then '00' when l_linenumber % 2 = 0 and l_partkey < 100 then '0' else '' end
 ||cast(l_partkey as string)||case l_linenumber % 4 when 1 then ' ' else '' end sku,
 case when l_orderkey % 97 = 0 then '?' else cast(cast(floor(l_quantity) as int) as string) end ilosc,
 cast(cast(floor(l_extendedprice) as int) as string)||',50 zł' cena_jedn
"""
SALES = """
select row_id, {_SALE} from {lineitem}
union all
select row_id + 1000000000000, {_SALE} from {lineitem}
 where year(l_shipdate) = 1997 and month(l_shipdate) = 3
""".replace("{_SALE}", _SALE)

# branch exports as they arrive: a total row below the data, with the control sum in the last column
SOLD = """
select row_id, oddzial, nr_transakcji, data, sku, ilosc, cena_jedn, cast(null as string) wartosc from ({SALES}) sales
"""
TOTALS = """
select 9000000000000, oddzial, cast(null as string),
 case oddzial when 'A' then ' suma' when 'B' then 'RAZEM' else 'Total ' end,
 cast(null as string), cast(null as string), cast(null as string),
 case when oddzial = 'C' then 'see invoice'
  else cast(cast((halves - halves % 2) / 2 as bigint) as string)||case halves % 2 when 1 then ',50 zł' else ',00 zł' end end
from (select oddzial, sum(case when ilosc = '?' then 0 else cast(ilosc as bigint) * (cast(replace(cena_jedn, ',50 zł', '') as bigint) * 2 + 1) end) halves
 from ({SALES}) sales group by oddzial) declared
"""
EXPORTS = f"{SOLD}union all{TOTALS}".replace("{SALES}", SALES)

# the whole part table; the codes of every twentieth part are sold under a number the catalog lacks
CATALOG = """
select case p_partkey % 2 when 0 then 'KAW-' else ' kaw ' end||cast(p_partkey as string) sku, p_name nazwa_produktu, p_type kategoria,
 cast(cast(floor(p_retailprice) as int) as string)||',00' cena_katalogowa from {part}
"""

# short and long texts of every provided kind: names, labels, whole documents and conversations
TEXTS = """
select 'doc-'||cast(doc_id as string) id, text from {documents}
union all select 'conv-'||cast(conv_id as string)||'-'||cast(turn as string), text from {conversations}
union all select 'crm-'||cast(row_id as string), imie_nazwisko from ({CRM}) crm
union all select 'city-'||cast(row_id as string), miasto from ({CRM}) crm
union all select 'part-'||cast(p_partkey as string), '  '||p_name||' / '||p_brand||'  ' from {part}
""".replace("{CRM}", CRM)
