"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code: the map is unpivoted with UNION ALL,
the N-way combine is a chain of FULL JOINs, empty folders come from a LEFT JOIN
from the map, rules are CASE expressions.
"""

from __future__ import annotations

ACCOUNTS = ["pro", "release", "dev"]
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
S3 = "'^s3://(.+?)/(.+)'"

# --------------------------------------------------------------------------- shared views

LISTING = """
listing AS (
  select 'pro' account, 'docs' bucket, source||'/'||lang||'/' prefix,
         cast(doc_id as varchar)||'.txt' name, to_timestamp(1704067200 + doc_id * 60)::timestamp date,
         n_chars size, md5(text) hash
  from documents where doc_id % 11 <> 0 or doc_id % 21 = 0
  union all
  select 'release', 'docs', source||'/'||lang||'/', cast(doc_id as varchar)||'.txt',
         to_timestamp(1704067200 + doc_id * 60)::timestamp,
         case when doc_id % 5 = 0 then n_chars + 2 else n_chars end,
         md5(case when doc_id % 5 = 0 then text||'#r' else text end)
  from documents where doc_id % 7 <> 0
  union all
  select 'dev', 'docs_dev', lang||'/dev_'||source||'/', cast(doc_id as varchar)||'.txt',
         to_timestamp(1704067200 + doc_id * 60)::timestamp,
         n_chars, md5(case when doc_id % 13 = 0 then text||'#d' else text end)
  from documents where doc_id % 3 <> 0
)"""

MAP_WIDE = """
map_wide AS (
  select distinct 's3://docs/'||source||'/'||lang pro, 's3://docs/'||source||'/'||lang release,
         's3://docs_dev/'||lang||'/dev_'||source||'/' dev
  from documents
  union all
  select 's3://docs/non-existent', 's3://docs/non-existent', 's3://docs_dev/non-existent'
)"""

MAP_WIDE_DIRTY = """
map_wide AS (
  select distinct 's3://docs/'||source||'/'||lang pro, 's3://docs/'||source||'/'||lang release,
         's3://docs_dev/'||lang||'/dev_'||source||'/' dev
  from documents
  union all
  select 's3://docs/non-existent', 's3://docs/non-existent', 's3://docs_dev/non-existent'
  union all
  select '  s3://docs/src0/en/  ', 's3://docs/src0/en/', 's3://docs_dev/en/dev_src0'
  union all
  select 's3://docs/', '   ', 'docs_dev/en/dev_src1/'
  union all
  select '  s3://docs/'||name||'/ ',
         case when v % 5 = 0 then '  ' when v % 5 = 1 then 's3://docs/'||source||'/all/' else 's3://docs/'||name end,
         case when v % 7 = 0 then 'docs_dev/'||name else 's3://docs_dev/'||name end
  from (select distinct source, doc_id % 50 v, source||'/v'||cast(doc_id % 50 as varchar) name from documents)
)"""

MAP_RAW_LONG = """
map_raw AS (
  select 'pro' account, pro uri, pro key_uri from map_wide
  union all select 'release', release, pro from map_wide
  union all select 'dev', dev, pro from map_wide
)"""

MAP_LONG = f"""
map_clean AS (
  select account, nullif(trim(uri, {WS}), '') uri, nullif(trim(key_uri, {WS}), '') key_uri from map_raw
),
map_long AS (
  select account, uri,
         nullif(regexp_extract(uri, {S3}, 1), '') bucket,
         nullif(regexp_extract(uri, {S3}, 2), '') key,
         regexp_replace(nullif(regexp_extract(uri, {S3}, 2), ''), '/$', '') || '/' prefix,
         nullif(regexp_extract(key_uri, {S3}, 1), '') key_bucket,
         regexp_replace(nullif(regexp_extract(key_uri, {S3}, 2), ''), '/$', '') || '/' key_prefix
  from map_clean
)"""

RAW_ENTRIES = """
raw AS (
  select account, bucket, prefix||name key, size, '"'||hash||'"' etag from listing
  union all
  select 'pro', 'docs', source||'/'||lang||'/v'||cast(doc_id // 512 as varchar)||'/'||case when doc_id % 46 = 0 then 'more/' else '' end
         ||cast(doc_id as varchar)||'.txt', n_chars, '"'||md5(text)||'"'
  from documents where doc_id % 23 = 0
  union all
  select * from (values
    ('pro', 'docs', 'src0/en/', 0, '"d41d8cd98f00b204e9800998ecf8427e"'),
    ('pro', 'docs', 'src1/en/', 5, '"0cc175b9c0f1b6a831c399e269772661"'),
    ('pro', 'docs', 'src0/en/deeper/x.txt', 7, '"9dd4e461268c8034f5c8564e155c67a6"'),
    ('pro', 'docs', 'src0/en/deeper/more/y.txt', 9, '"415290769594460e2e485922904f345d"'),
    ('pro', 'docs', 'src0/en/other/z.txt', 3, '"fbade9e36a3f36d3d676c1b808451dd7"'),
    ('release', 'docs', 'src2/fr/old/z.txt', 3, '"fbade9e36a3f36d3d676c1b808451dd7"'),
    ('pro', 'docs', 'non-existent/', 0, '"d41d8cd98f00b204e9800998ecf8427e"'),
    ('dev', 'docs_dev', 'xx/stray.txt', 4, '"8277e0910d750195b448797616e091ad"')
  ) t(account, bucket, key, size, etag)
),
records AS (
  select account, bucket, regexp_extract(key, '^(.*/)', 1) prefix,
         regexp_extract(key, '([^/]*)/*$', 1) name, size, trim(etag, '"') hash, key
  from raw
  where not (key like '%/' and size = 0)
)"""

LISTING_STRAYS = """
listing_strays AS (
  select account, bucket, prefix, name, size, hash from listing
  union all
  select * from (values
    ('dev', 'docs_dev', 'xx/', 'stray.txt', 4, '8277e0910d750195b448797616e091ad'),
    ('release', 'docs', 'src0/zz/', 'lost.txt', 3, 'fbade9e36a3f36d3d676c1b808451dd7')
  ) t(account, bucket, prefix, name, size, hash)
  union all
  select 'release', 'docs', 'lost/'||lang||'/', cast(doc_id as varchar)||'.txt', n_chars, md5(text)
  from documents where doc_id % 17 = 0
)"""


ORDERS_LISTING = """
o AS (
  select cast(o_orderkey as varchar)||'.json' name, o_orderdate::timestamp date, o_custkey size,
         o_orderpriority||'/'||cast(year(o_orderdate) as varchar)||'/' prod_prefix,
         cast(year(o_orderdate) as varchar)||'/'||o_orderpriority||'/' dev_prefix,
         concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) content,
         o_orderstatus st, o_orderpriority pr, year(o_orderdate) yr
  from orders
),
listing AS (
  select 'pro' account, 'sales' bucket, prod_prefix prefix, name, date, size, md5(content) hash from o
  union all
  select 'release', 'sales', prod_prefix, name, date,
         case when st = 'O' and pr = '1-URGENT' then size + 1 else size end,
         md5(case when st = 'O' and pr = '1-URGENT' then content||'#r' else content end)
  from o where st <> 'P'
  union all
  select 'dev', 'sales_dev', dev_prefix, name, date, size,
         md5(case when st = 'O' and pr = '5-LOW' then content||'#d' else content end)
  from o where not (st = 'F' and yr < 1997)
)"""

ORDERS_MAP_WIDE = """
map_wide AS (
  select distinct 's3://sales/'||o_orderpriority||'/'||cast(year(o_orderdate) as varchar) pro,
         's3://sales/'||o_orderpriority||'/'||cast(year(o_orderdate) as varchar) release,
         's3://sales_dev/'||cast(year(o_orderdate) as varchar)||'/'||o_orderpriority dev
  from orders
  union all
  select 's3://sales/returns', 's3://sales/returns', 's3://sales_dev/returns'
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _combined() -> str:
    """Re-key through the map, then a chained FULL JOIN of the accounts on (bucket, prefix, name)."""
    per_account = []
    for a in ACCOUNTS:
        per_account.append(
            f"""
t_{a} AS (
  select m.key_bucket b, m.key_prefix f, l.name, l.date, l.size, l.hash
  from listing l join (select distinct account, bucket, prefix, key_bucket, key_prefix from map_long
                       where bucket is not null and key_bucket is not null) m
    on l.account = m.account and l.bucket = m.bucket and l.prefix = m.prefix
  where l.account = '{a}' and (l.date is not null or l.size is not null or l.hash is not null)
)"""
        )
    p, r, d = ACCOUNTS
    joined = f"""
combined AS (
  select coalesce(t_{p}.b, t_{r}.b, t_{d}.b) b, coalesce(t_{p}.f, t_{r}.f, t_{d}.f) f,
         coalesce(t_{p}.name, t_{r}.name, t_{d}.name) name,
         t_{p}.date date_in_{p}, t_{p}.size size_in_{p}, t_{p}.hash hash_in_{p},
         t_{r}.date date_in_{r}, t_{r}.size size_in_{r}, t_{r}.hash hash_in_{r},
         t_{d}.date date_in_{d}, t_{d}.size size_in_{d}, t_{d}.hash hash_in_{d}
  from t_{p}
  full join t_{r} on t_{p}.b = t_{r}.b and t_{p}.f = t_{r}.f and t_{p}.name = t_{r}.name
  full join t_{d} on coalesce(t_{p}.b, t_{r}.b) = t_{d}.b and coalesce(t_{p}.f, t_{r}.f) = t_{d}.f
                 and coalesce(t_{p}.name, t_{r}.name) = t_{d}.name
)"""
    return ",".join(per_account) + "," + joined


ATTR_COLS = ", ".join(f"{attr}_in_{a}" for a in ACCOUNTS for attr in ("date", "size", "hash"))

ALL_ACCOUNTS_CTE = f"""
folders AS (
  select distinct key_bucket b, key_prefix f from map_long where account = 'pro' and key_bucket is not null
),
all_accounts AS (
  select folders.b bucket_in_pro, folders.f prefix_in_pro, c.name file_name_in_all_accounts, {", ".join("c." + x.strip() for x in ATTR_COLS.split(","))}
  from folders left join combined c on folders.b = c.b and folders.f = c.f
)"""


def _all_accounts_with() -> str:
    return _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG) + "," + _combined() + "," + ALL_ACCOUNTS_CTE


def _hash_rule(o: str, t: str) -> str:
    return (
        f"case when size_in_{o} is not null then coalesce(hash_in_{o} = hash_in_{t}, false) "
        f"when size_in_{t} is not null then false end as is_hash_the_same_in_{t}"
    )


def _exist_rule(o: str, t: str) -> str:
    return f"case when size_in_{o} is null and size_in_{t} is not null then false end as can_exist_in_{t}"


KEY_COLS = "bucket_in_pro, prefix_in_pro, file_name_in_all_accounts"


def oracle_sql() -> dict[str, str]:
    dirty = _with(MAP_WIDE_DIRTY, MAP_RAW_LONG, MAP_LONG)
    clean = _with(MAP_WIDE, MAP_RAW_LONG, MAP_LONG)
    raw = _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG, RAW_ENTRIES)
    all_acc = _all_accounts_with()
    q: dict[str, str] = {}

    q["uri_parts"] = (
        dirty
        + f"""
select account, uri, bucket, key, prefix,
       case when bucket is not null then 's3://'||bucket||'/'||prefix end uri_rendered,
       regexp_matches(uri, {S3}) is_valid
from map_long"""
    )
    q["url_parts_pages"] = """
select page_id, url, host, key, regexp_extract(key, '^(.*/)', 1) folder, regexp_extract(key, '([^/]*)/*$', 1) name
from (select page_id, url,
             nullif(regexp_extract(url, '^https?://(.+?)/(.+)', 1), '') host,
             nullif(regexp_extract(url, '^https?://(.+?)/(.+)', 2), '') key
      from pages) p"""
    q["map_unpivot"] = clean + "\nselect account, uri, bucket, prefix, key_bucket, key_prefix from map_long"
    q["map_clean"] = (
        _with(MAP_WIDE_DIRTY, MAP_RAW_LONG)
        + f"""
select account, uri uri_raw, nullif(trim(uri, {WS}), '') uri, nullif(trim(uri, {WS}), '') is null is_empty
from map_raw"""
    )
    q["map_any_null"] = dirty + "\nselect coalesce(bool_or(uri is null), false) any_null_uri from map_long"
    q["map_duplicates"] = (
        dirty
        + """
select account, bucket, prefix, count(*) n_uris
from map_long where bucket is not null
group by account, bucket, prefix having count(*) > 1"""
    )
    q["map_invalid_uris"] = dirty + f"\nselect account, uri from map_long where uri is not null and not regexp_matches(uri, {S3})"

    q["listing_files_only"] = raw + "\nselect account, bucket, prefix, name, size, hash from records"
    q["listing_subfolders"] = (
        raw
        + """
, deep AS (
  select distinct f.account, f.bucket, f.prefix,
         f.prefix || split_part(substr(r.key, length(f.prefix) + 1), '/', 1) || '/' subfolder
  from (select distinct account, bucket, prefix from map_long where bucket is not null) f
  join raw r on r.account = f.account and r.bucket = f.bucket
   and starts_with(r.key, f.prefix)
   and position('/' in substr(r.key, length(f.prefix) + 1)) > 0
)
select account, bucket, prefix, subfolder, count(*) over (partition by account, bucket, prefix) n_subfolders
from deep"""
    )
    q["listing_with_placeholders"] = (
        raw
        + """
, folders AS (select distinct account, bucket, prefix from map_long where bucket is not null),
files AS (
  select r.account, r.bucket, r.prefix, r.name, r.size, r.hash from records r
  where exists (select 1 from folders f where f.account = r.account and f.bucket = r.bucket and f.prefix = r.prefix)
)
select * from files
union all
select f.account, f.bucket, f.prefix, null, null, null from folders f
where not exists (select 1 from files x where x.account = f.account and x.bucket = f.bucket and x.prefix = f.prefix)"""
    )
    q["listing_hash_kinds"] = (
        raw
        + """
, folders AS (select distinct account, bucket, prefix from map_long where bucket is not null)
select r.account,
       case when r.hash is null then null
            when regexp_matches(r.hash, '^[0-9a-f]{32}$') then 'md5'
            when regexp_matches(r.hash, '^[0-9a-f]{32}-[0-9]+$') then 'multipart'
            else 'other' end hash_kind,
       count(*) n_objects
from records r
where exists (select 1 from folders f where f.account = r.account and f.bucket = r.bucket and f.prefix = r.prefix)
group by all"""
    )
    q["listing_duplicate_keys"] = """
select 'lineitem' account, 'tpch' bucket, 'orders/'||cast(l_orderkey as varchar)||'/' prefix,
       cast(l_linenumber as varchar)||'.row' name, count(*) n_copies
from lineitem group by l_orderkey, l_linenumber having count(*) > 1"""

    strays = _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG, LISTING_STRAYS)
    q["rekey"] = (
        strays
        + """
select l.account, m.key_bucket, m.key_prefix, l.name, l.size, l.hash
from listing_strays l left join (select distinct account, bucket, prefix, key_bucket, key_prefix from map_long
                                 where bucket is not null and key_bucket is not null) m
  on l.account = m.account and l.bucket = m.bucket and l.prefix = m.prefix
where m.key_bucket is not null"""
    )
    q["unmapped_objects"] = (
        strays
        + """
select l.account, l.bucket, l.prefix, l.name from listing_strays l
where not exists (select 1 from map_long m where m.bucket is not null and m.key_bucket is not null
                  and m.account = l.account and m.bucket = l.bucket and m.prefix = l.prefix)"""
    )
    q["rekey_counts"] = (
        strays
        + """
, keys AS (
  select account, bucket, prefix, count(*) n_keys
  from (select distinct account, bucket, prefix, key_bucket, key_prefix from map_long
        where bucket is not null and key_bucket is not null) d
  group by account, bucket, prefix
)
select l.account, count(*) n_rows, cast(coalesce(sum(k.n_keys), 0) as bigint) n_rekeyed,
       count(*) filter (where k.n_keys is null) n_unmapped
from listing_strays l left join keys k on l.account = k.account and l.bucket = k.bucket and l.prefix = k.prefix
group by l.account"""
    )
    q["combine_full_outer"] = (
        _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG)
        + ","
        + _combined()
        + f"""
select b bucket_in_pro, f prefix_in_pro, name file_name_in_all_accounts, {ATTR_COLS} from combined"""
    )
    q["all_accounts"] = all_acc + "\nselect * from all_accounts"
    q["rule_hash_match"] = (
        all_acc + f"\nselect {KEY_COLS}, {_hash_rule('pro', 'release')}, {_hash_rule('pro', 'dev')} from all_accounts"
    )
    q["rule_can_exist"] = (
        all_acc + f"\nselect {KEY_COLS}, {_exist_rule('pro', 'release')}, {_exist_rule('pro', 'dev')} from all_accounts"
    )
    q["analysis_full"] = (
        all_acc
        + f"""
select *, {_hash_rule('pro', 'release')}, {_hash_rule('pro', 'dev')}, {_exist_rule('pro', 'release')}
from all_accounts"""
    )
    q["analysis_other_origin"] = (
        all_acc
        + f"""
select *, {_hash_rule('release', 'pro')}, {_hash_rule('release', 'dev')},
       {_exist_rule('release', 'pro')}, {_exist_rule('release', 'dev')}
from all_accounts"""
    )
    q["orders_analysis"] = (
        _with(ORDERS_LISTING, ORDERS_MAP_WIDE, MAP_RAW_LONG, MAP_LONG)
        + ","
        + _combined()
        + ","
        + ALL_ACCOUNTS_CTE
        + f"""
select *, {_hash_rule('pro', 'release')}, {_hash_rule('pro', 'dev')}, {_exist_rule('pro', 'release')}
from all_accounts"""
    )
    q["rules_unknown_accounts"] = """
with known AS (select distinct source account from documents),
targets AS (
  select distinct case when lang = 'en' then source||'-'||cast(n_chars // 500 as varchar) else source end account from documents
  union
  select distinct source||'_'||lang from documents
),
bad AS (
  select 'origin' chk, max(source)||'-none' account from documents
  union all
  select 'targets', account from targets where account not in (select account from known)
)
select chk "check", count(*) n_accounts, string_agg(account, ', ' order by account) accounts,
       case when count(*) = 1
            then 'The AWS account ''' || string_agg(account, ''', ''' order by account) || ''' is defined in analysis-config.json but not in s3-uris-to-analyze.csv'
            else 'The AWS accounts ''' || string_agg(account, ''', ''' order by account) || ''' are defined in analysis-config.json but not in s3-uris-to-analyze.csv'
       end message
from bad group by chk"""
    q["pending_accounts"] = (
        _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG)
        + """
, accts AS (select * from (values ('pro', 0), ('release', 1), ('dev', 2)) t(account, account_ord)),
pending AS (
  select a.account, a.account_ord from accts a
  where not exists (select 1 from listing l where l.account <> 'dev' and l.account = a.account)
)
select account, account_ord, account_ord = (select min(account_ord) from pending) is_next from pending"""
    )
    q["round_trip_csv"] = q["all_accounts"]
    q["listing_csv_round_trip"] = q["listing_with_placeholders"]
    q.update(_written(q, dirty))
    return q


# --------------------------------------------------------------------------- the written path

ODD_NAME = """case doc_id % 5 when 0 then ' '||cast(doc_id as varchar)||'.csv '
  when 1 then 'a"'||cast(doc_id as varchar)||'",b.csv'
  when 2 then cast(doc_id as varchar)||chr(10)||'line'||chr(13)||chr(10)||'break.csv'
  when 3 then '"'||cast(doc_id as varchar)||'\\".csv'
  else cast(doc_id as varchar)||'.csv' end"""
ODD_DATE = "make_timestamp(1704067200000000 + doc_id * 60000000 + doc_id % 3 * 123456)"
NUMBERED = {"pro": "012345678901", "release": "123456789012", "dev": "000000000007"}
DATE = "to_timestamp(1704067200 + doc_id * 60)::timestamp"


def _written(q: dict[str, str], dirty: str) -> dict[str, str]:
    odd = lambda sql: sql.replace("cast(doc_id as varchar)||'.txt'", ODD_NAME).replace(DATE, ODD_DATE)
    full = q["analysis_full"]
    numbered = _with(LISTING, MAP_WIDE, MAP_RAW_LONG, MAP_LONG)
    number = "case l.account " + " ".join(f"when '{a}' then '{n}'" for a, n in NUMBERED.items()) + " end"
    return {
        "full_diff_written": full,
        "full_diff_csv": odd(q["all_accounts"]),
        "analysis_csv": odd(full),
        "full_diff_rerun": full.replace("from documents where doc_id % 3 <> 0", "from documents where false"),
        "full_diff_earlier_run": full.replace("from documents where doc_id % 11 <> 0 or doc_id % 21 = 0", "from documents where doc_id % 4 <> 0 and (doc_id % 11 <> 0 or doc_id % 21 = 0)")
        .replace("from documents where doc_id % 7 <> 0", "from documents where doc_id % 4 <> 0 and doc_id % 7 <> 0")
        .replace("from documents where doc_id % 3 <> 0", "from documents where doc_id % 4 <> 0 and doc_id % 3 <> 0"),
        "full_diff_subfolders": q["listing_subfolders"],
        "numeric_accounts": numbered
        + f"""
, folders AS (select distinct account, bucket, prefix from map_long where bucket is not null),
filled AS (
  select account, bucket, prefix, name, size, hash from listing
  union all
  select f.account, f.bucket, f.prefix, null, null, null from folders f
  where not exists (select 1 from listing x where x.account = f.account and x.bucket = f.bucket and x.prefix = f.prefix)
)
select s.source, {number} account, l.bucket, l.prefix, l.name, l.size, l.hash
from filled l cross join (values ('parquet'), ('csv')) s(source)""",
        "combine_duplicate_keys": """
with l AS (
  select 'orders/'||cast(l_orderkey as varchar)||'/' prefix, cast(l_linenumber as varchar)||'.row' name,
         l_shipdate::timestamp date, cast(l_quantity as bigint) size, l_partkey, l_suppkey, l_extendedprice
  from lineitem
), h AS (
  select prefix, name, date, size, md5(concat_ws('|', l_partkey, l_suppkey, l_extendedprice)) hash from l
), both_accounts AS (select *, 'a' account from h union all select *, 'b' from h where size % 3 <> 0),
n AS (select *, row_number() over (partition by prefix, name, account, hash order by date, size) nth from both_accounts),
c AS (select *, count(*) over (partition by prefix, name, hash, nth) holders from n),
p AS (
  select *, case when holders = 2 then dense_rank() over (partition by prefix, name, holders order by hash, nth)
    else row_number() over (partition by prefix, name, account, holders order by date, size, hash) end place from c
), a AS (select * from p where account = 'a'), b AS (select * from p where account = 'b')
select 'tpch' bucket_in_all, coalesce(a.prefix, b.prefix) prefix_in_all, coalesce(a.name, b.name) file_name_in_all_accounts,
       a.date date_in_all, a.size size_in_all, a.hash hash_in_all, b.date date_in_name, b.size size_in_name, b.hash hash_in_name
from a full join b on a.prefix = b.prefix and a.name = b.name and a.holders = b.holders and a.place = b.place""",
        "map_file_round_trip": dirty + "\nselect account, uri, bucket, prefix, key_bucket, key_prefix from map_long",
        "map_empty_account": _with(MAP_WIDE)
        + """
select 0 account_ord, false is_empty, count(distinct pro) n_uris from map_wide
union all select 1, true, count(distinct release) from map_wide
union all select 2, false, count(distinct dev) from map_wide""",
        "rule_config_file": """
with c AS (
  select 'is_hash_the_same_in' rule, source target from documents where lang = 'de' group by source
  union all
  select 'can_the_file_exist_in', source from documents where lang = 'en' group by source
)
select rule, row_number() over (partition by rule order by target) - 1 ord, target, (select max(source) from documents) origin, true run_analysis from c""",
        "struct_form": q["all_accounts"],
        "account_pair": _with(MAP_WIDE_DIRTY) + "\nselect pro, dev from map_wide",
        "prefix_check": _with(LISTING)
        + """
select account, bool_and(not (account = 'dev' and prefix like 'fr/%')) all_end_in_slash from listing group by account""",
        "analysis_ordered": _all_accounts_with()
        + """
, ords AS (select pro, row_number() over (order by pro desc) ord from map_wide),
keyed AS (select ord, regexp_extract(pro, '^s3://(.+?)/(.+)', 1) b, regexp_extract(pro, '^s3://(.+?)/(.+)', 2)||'/' f from ords)
select row_number() over (order by ord, file_name_in_all_accounts nulls first) - 1 "position",
       bucket_in_pro, prefix_in_pro, file_name_in_all_accounts, hash_in_dev
from all_accounts join keyed on b = bucket_in_pro and f = prefix_in_pro""",
        "inventory_listing": q["listing_with_placeholders"],
        "binaryfile_listing": """
select 'pro' account, 'docs' bucket, 'folder='||source||'_'||lang||'/' prefix,
       cast(sum(octet_length(encode(text)) + 1) as bigint) size, 0::bigint n_placeholders
from documents group by source, lang
union all select 'pro', 'docs', 'folder=none/', null, 1""",
        "object_hashes": """
select 'pro' account, 'folder='||source||'_'||lang||'/part='||cast(doc_id // 2048 as varchar)||'/' prefix,
       cast(sum(octet_length(encode(coalesce(text, ''))) + 1) as bigint) size, md5(string_agg(coalesce(text, '')||chr(10), '' order by doc_id, text)) hash
from documents group by source, lang, doc_id // 2048""",
        "multipart_hashes": """
with o AS (
  select 'folder='||source||'_'||lang||'/part='||cast(doc_id // 256 as varchar)||'/' prefix,
         string_agg(md5(coalesce(text, ''))||chr(10), '' order by doc_id, md5(coalesce(text, ''))) content
  from documents group by source, lang, doc_id // 256
), p AS (
  select prefix, content, i, substr(content, i * 528 + 1, 528) part
  from (select prefix, content, unnest(range(0, (length(content) + 527) // 528)) i from o)
)
select 'pro' account, prefix, length(content) size,
       case when length(content) < 528 then md5(content)
            else md5(unhex(string_agg(md5(part), '' order by i)))||'-'||cast(count(*) as varchar) end hash,
       case when length(content) < 528 then 'md5' else 'multipart' end hash_kind
from p group by prefix, content""",
        "unlike_hashes": """
select 'pro' origin, 'dev' target, 'md5' origin_kind, 'multipart' target_kind, count(*) n_objects
from documents where doc_id % 5 = 0 and doc_id % 3 <> 0 and (doc_id % 11 <> 0 or doc_id % 21 = 0)
having count(*) > 0""",
    }
