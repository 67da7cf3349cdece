"""DuckDB text for every named query (the driver's oracle).

Column names equal those of the Spark queries in :mod:`reachset.plans.named`.
The driver registers the parquet tables as views of the same names.
"""

import re
import unicodedata

from .any_signal import TECH_KEYWORDS


def re2_keyword_pattern(words) -> str:
    """Whole-word, case-insensitive alternation in RE2 syntax (no lookbehind),
    the same keyword set as ``keyword_pattern`` builds for Java."""
    seen = {}
    for w in words:
        w = w.strip()
        if w:
            for form in (unicodedata.normalize("NFC", w), unicodedata.normalize("NFD", w), w):
                seen.setdefault(form, None)
    alts = sorted(seen, key=lambda s: (-len(s), s))
    body = "|".join(re.escape(a) for a in alts)
    return f"(?i)(^|[^\\pL\\pM\\pN])({body})([^\\pL\\pM\\pN]|$)"


SQL: dict[str, str] = {
    "event_window": r"""
select event_id, user_id from events where ts>=timestamp '2024-01-10 06:00:00' and ts<timestamp '2024-01-25 18:30:00'
""",
    "union_sources": """
select distinct account_id from (select user_id as account_id, event_type as kind from events union all select o_custkey, o_orderstatus from orders) u where kind in ('click','F') and account_id>0
""",
    "intersect_sources": """
select a.account_id from (select user_id as account_id, count(*) as n from events where event_type='signup' and ts>=timestamp '2024-01-10' and ts<timestamp '2024-01-20' and user_id>0 group by user_id) a join (select o_custkey as account_id, count(*) as n from orders where o_orderstatus='F' and o_custkey>0 group by o_custkey) b on a.account_id=b.account_id where a.n>0 and b.n>0
""",
    "profile_lookup": r"""
select e.account_id, c.c_name as name, n.n_name as home from (select distinct user_id as account_id from events where event_type='signup') e join customer c on c.c_custkey=e.account_id left join nation n on n.n_nationkey=c.c_nationkey
""",
    "profile_linked": r"""
select e.account_id, c.c_name as name, n.n_name as home from (select distinct user_id as account_id from events where event_type='signup') e left join customer c on c.c_custkey=e.account_id left join nation n on n.n_nationkey=case when c.c_custkey%7<>0 then c.c_nationkey end
""",
    "scrub_accounts": r"""
select c_custkey as account_id from customer where not exists (select 1 from supplier where s_suppkey=c_custkey and (case when s_acctbal>=0 then s_acctbal end) is not null)
""",
    "filter_compare": r"""
select event_id from (select *, case when user_id%5=0 then '' when user_id%7=0 then null else event_type end as label from events) e where label<>'' and label<>'view' and user_id<>7 and value>50
""",
    "filter_in_list": """
select c_custkey from customer where c_mktsegment in ('BUILDING','MACHINERY')
""",
    "filter_boolean_mix": """
select distinct user_id from events where user_id<>7 and (event_type in ('view','click') or (event_type='purchase' and value>60)) and value>20
""",
    "regex_full_match": """
select p_partkey from part where regexp_full_match(p_name, '.*widget|red ring|blue bol*.')
""",
    "keyword_any": """
select p_partkey from part where p_name like '%widget%' or p_name like '%bolt%' or p_name like '%red%'
""",
    "regex_prefix": """
select p_partkey from part where starts_with(p_name,'blue')
""",
    "multivalue_any": """
select p_partkey from part where list_has_any(string_split(p_name,' '), ['red','anvil'])
""",
    "multivalue_group": """
select token, count(*) as n from (select unnest(string_split(p_name,' ')) as token from part) t group by token
""",
    "preset_filter": """
select c.c_custkey, p.city from customer c join nation n on n.n_nationkey=c.c_nationkey join (select 'Hub A' as preset, 'ASIA' as metro, 'NATION_2' as city) p on true join region r on r.r_regionkey=n.n_regionkey and r.r_name=p.metro where p.preset='Hub A'
""",
    "semi_chain": """
select distinct l_suppkey from lineitem where l_returnflag<>'R' and l_quantity>40 and l_orderkey in (select o_orderkey from orders where o_orderstatus='F' and o_orderpriority='1-URGENT' and o_custkey in (select c_custkey from customer where c_mktsegment='BUILDING' and c_nationkey in (select n_nationkey from nation where n_regionkey in (select r_regionkey from region where r_name='ASIA'))))
""",
    "semi_keys": r"""
select distinct c_name, c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderstatus='F' and o_orderpriority='1-URGENT')
""",
    "inner_audience": r"""
select a.account_id from (select distinct user_id as account_id from events where event_type='view') a join (select distinct user_id as account_id from events where event_type='click') b on a.account_id=b.account_id
""",
    "full_attributes": r"""
select coalesce(a.account_id,b.account_id) as account_id, a.n_click, b.n_signup from (select user_id as account_id, count(*) as n_click from events where event_type='click' group by user_id) a full join (select user_id as account_id, count(*) as n_signup from events where event_type='signup' group by user_id) b on a.account_id=b.account_id
""",
    "union_audiences": r"""
select user_id as account_id from events where event_type='click' and value>60 union select o_custkey from orders where o_orderpriority='1-URGENT' union select c_custkey from customer where c_mktsegment='BUILDING'
""",
    "anti_audience": r"""
select distinct user_id as account_id from events e where event_type='view' and not exists (select 1 from events s where s.user_id=e.user_id and s.event_type='purchase' and s.value>60)
""",
    "distinct_keys": r"""
select user_id as account_id, count(*) as n from events group by user_id
""",
    "group_multi_key": """
select o_custkey, o_orderstatus, o_orderpriority, count(*) as n from orders group by o_custkey, o_orderstatus, o_orderpriority
""",
    "distinct_count": """
select event_type, count(distinct user_id) as accounts from events group by event_type
""",
    "distinct_bitmaps": """
select event_type, count(distinct user_id) as users from events group by event_type union all select 'all', count(distinct user_id) from events
""",
    "moved_window": """
select user_id, count(*) as n from events where ts >= '2024-01-06' and ts < '2024-01-26' and user_id is not null group by user_id
""",
    "filtered_semi_keys": """
select l_orderkey as o_orderkey, l_linenumber, l_suppkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority='1-URGENT' and o_orderstatus='O')
""",
    "drop_incomplete": """
select distinct e.user_id as account_id, n.n_name as city from events e left join (select c_custkey, n_name from customer join nation on n_nationkey=c_nationkey where n_regionkey<2) n on n.c_custkey=e.user_id where n.n_name is not null
""",
    "fill_defaults": """
select c.c_custkey as account_id, coalesce(n.n_name,'Hub A') as city from customer c left join (select * from nation where n_regionkey=2) n on n.n_nationkey=c.c_nationkey
""",
    "shape_output": """
select distinct cast(c_custkey as int) as accountId, c_name as company, '' as firstName from customer
""",
    "date_offset": """
select o_orderkey from orders where o_orderdate>=timestamp '1998-12-01' - interval 30 day and o_orderdate<timestamp '1998-12-01'
""",
    "unconverted_audience": """
with base as (select distinct user_id from events where event_type='view' and ts>=timestamp '2024-01-15' and ts<timestamp '2024-01-31'),
opt as (select distinct user_id from events where event_type='click' and ts>=timestamp '2024-01-15' and ts<timestamp '2024-01-31'),
spent as (select distinct user_id from events where event_type='purchase' and ts>=timestamp '2024-01-28' and ts<timestamp '2024-01-30')
select distinct cast(b.user_id as int) as advertiserId, c.c_name as company from base b join opt o on b.user_id=o.user_id join customer c on c.c_custkey=b.user_id where not exists (select 1 from spent s where s.user_id=b.user_id)
""",
    "any_signal_audience": """
with new_accounts as (select distinct user_id as k from events where event_type='signup' and ts>=timestamp '2024-01-28' and ts<timestamp '2024-01-30')
select cast(k as int) as accountId, '' as firstName from (select user_id as k from events where event_type='click' and value>20 and user_id>0 union select user_id from events where event_type='view' and user_id>0 union select o_custkey from orders where o_orderpriority in ('1-URGENT','2-HIGH') and o_custkey>0 union select c_custkey from customer where c_mktsegment='BUILDING' and c_custkey>0) u where not exists (select 1 from new_accounts n where n.k=u.k)
""",
    "market_audience": """
with metro as (select n_nationkey, n_name from nation where n_regionkey in (select r_regionkey from region where r_name='ASIA')),
alerts as (select distinct o.o_custkey as k, m.n_name as city from orders o join customer c on c.c_custkey=o.o_custkey join metro m on m.n_nationkey=c.c_nationkey where o.o_orderpriority='1-URGENT'),
accounts as (select distinct user_id as k from events where event_type='signup' and ts>=timestamp '2024-01-20' and ts<timestamp '2024-01-31'),
audience as (select coalesce(a.k,n.k) as k, a.city from alerts a full join accounts n on a.k=n.k)
select audience.k as accountId, coalesce(audience.city,'Hub A') as City, c.c_name as firstName from audience left join customer c on c.c_custkey=audience.k where not exists (select 1 from supplier sp where sp.s_suppkey=audience.k and sp.s_acctbal>5000)
""",
    "code_filter": r"""
select doc_id, upper(trim(code)) as lang from (select doc_id, case when doc_id%5=0 then ' '||lang||' ' when doc_id%7=0 then lang||'a' when doc_id%3=0 then upper(lang) else lang end as code from documents) d where regexp_full_match(trim(code), '[A-Za-z]{2}') and lower(trim(code)) in ('fr','de')
""",
    "date_text": r"""
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders
""",
    "json_roundtrip": r"""
select c_custkey as accountId, case when c_custkey%11=0 then '' when c_custkey%13=0 then null when c_custkey%17=0 then 'say "hi" \ '||c_name when c_custkey%19=0 then c_name||chr(10)||'line two' when c_custkey%23=0 then '  '||c_name||', x ' else c_name end as firstName from customer
""",
    "csv_roundtrip": r"""
select c_custkey as accountId, case when c_custkey%11=0 then '' when c_custkey%13=0 then null when c_custkey%17=0 then 'say "hi" \ '||c_name when c_custkey%19=0 then c_name||chr(10)||'line two' when c_custkey%23=0 then '  '||c_name||', x ' else c_name end as firstName, c_mktsegment as City from customer
""",
    "not_equal_nulls": r"""
select p_partkey from (select p_partkey, case when p_size>10 then p_brand end as brand, case when p_size>20 then string_split(p_name,' ') end as words, string_split(p_name,' ')[1] as word from part) p where (brand is null or brand not in ('Brand#11','Brand#12')) and not coalesce(list_contains(words,'red'), false) and (word is null or word<>'blue')
""",
    "ids_as_text": r"""
select try_cast(account as bigint) as account_id, count(*) as n from (select case when o_orderkey%11=0 then 'abc' when o_orderkey%13=0 then '' when o_orderkey%17=0 then '99999999999999999999' else cast(o_custkey as varchar) end as account from orders) o where try_cast(account as bigint)>0 group by 1
""",
    "near_market_metro": r"""
select c_custkey, n_name, 'HA' as state from customer join nation on n_nationkey=c_nationkey where c_mktsegment in ('BUILDING','MACHINERY') and n_name in (select n_name from nation join region on r_regionkey=n_regionkey where r_name='ASIA')
""",
    "all_markets": r"""
select 'Hub A' as market, true as metro, c_custkey, n_name, 'HA' as state from customer join nation on n_nationkey=c_nationkey where c_mktsegment in ('BUILDING','MACHINERY') and n_name in (select n_name from nation join region on r_regionkey=n_regionkey where r_name='ASIA') union all select 'Hub A', false, c_custkey, n_name, 'HA' from customer join nation on n_nationkey=c_nationkey where c_mktsegment in ('BUILDING') and n_name='NATION_2'
""",
    "near_market_city": r"""
select c_custkey, n_name, 'HA' as state from customer join nation on n_nationkey=c_nationkey where c_mktsegment in ('BUILDING') and n_name='NATION_2'
""",
    "unconverted_chain": r"""
with base as (select distinct l_suppkey as k from lineitem where l_returnflag is null or l_returnflag<>'R'),
opt as (select distinct l_suppkey as k from lineitem where l_discount>=0.1 and l_orderkey in (select o_orderkey from orders where o_orderstatus='F')),
spent as (select distinct l_suppkey as k from lineitem where l_quantity>49 and l_orderkey in (select o_orderkey from orders where o_orderstatus='F' and o_orderpriority='1-URGENT' and o_custkey in (select c_custkey from customer where c_mktsegment='BUILDING')))
select distinct cast(b.k as int) as advertiserId, s_name as company from base b join opt o on o.k=b.k join supplier on s_suppkey=b.k where b.k not in (select k from spent)
""",
    "keyword_words": r"""
select p_partkey from part where regexp_matches(p_name, '(?i)(^|[^\pL\pM\pN])(widget|bolt|red)([^\pL\pM\pN]|$)')
""",
    "keyword_documents": "select doc_id from documents where regexp_matches(text, '"
    + re2_keyword_pattern(TECH_KEYWORDS).replace("'", "''")
    + "')",
    "keyword_attribution": """
select p_partkey, keyword from part, (values ('widget', 'widget'), ('Bolt', 'bolt'), ('RED', 'red'), ('red widget', 'red widget'), ('Blue  bolt', 'blue  bolt'), ('blue bolt', 'blue bolt'), ('dget', 'dget')) as k(keyword, word)
where regexp_matches(p_name, '(?i)(^|[^\\pL\\pM\\pN])' || word || '([^\\pL\\pM\\pN]|$)')
""",
}
