"""Plain SQL for the queries in :mod:`residualkit.plans.catalog`.

Each text states the meaning of its query directly, mostly with window
functions over whole tables, and shares no code with the operators. It is only
run on small data, to check results. For queries that fit trees it states what any
right result has: rows, sums, limits.
"""

from __future__ import annotations

TX = """
tx as (
  select *, case when logerror < 2e0 then logerror end as observed
  from (
    select o_orderkey as row_key, o_custkey as parcel, cast(o_orderdate as date) as dt,
           cast(year(o_orderdate) as int) as year,
           cast(month(o_orderdate) as int) as month,
           cast(day(o_orderdate) as int) as day,
           cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) as int) as month_block,
           ln(avg(o_totalprice) over (partition by o_orderpriority)) - ln(o_totalprice) as logerror
    from orders
  )
)"""

SNAPSHOTS = """
first_list as (
  select c_custkey as parcelid,
         case when c_mktsegment <> 'BUILDING' then c_nationkey end as regionid,
         case when c_acctbal >= 0 then sqrt(c_acctbal) end as balancecnt,
         c_mktsegment as usecode
  from customer
),
second_list as (
  select c_custkey as parcelid,
         case when c_mktsegment <> 'FURNITURE' then 24 - c_nationkey end as regionid,
         case when c_acctbal >= 0 and c_acctbal <= 9500 then sqrt(c_acctbal) * 1.25e0 end as balancecnt,
         case when c_mktsegment <> 'HOUSEHOLD' then c_mktsegment end as usecode
  from customer
  where c_acctbal > -900
),
wide as (
  select a.parcelid, a.regionid, a.balancecnt, a.usecode,
         b.regionid as regionid_2, b.balancecnt as balancecnt_2, b.usecode as usecode_2
  from first_list a left join second_list b on a.parcelid = b.parcelid
),
stacked as (
  select parcelid, 1998 as snapshot_year, regionid, balancecnt, usecode from wide
  union all
  select parcelid, 1999, regionid_2, balancecnt_2, usecode_2 from wide
)"""

SEGMENTED = (
    TX
    + """,
segmented as (
  select tx.*, c_nationkey as nation,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as segment
  from tx left join customer on c_custkey = parcel
),
folded as (
  select *, cast(ntile(5) over (order by dt, row_key) - 1 as int) as fold from segmented
)"""
)

PARTLY_GROUPED = (
    TX
    + """,
grouped as (
  select row_key, month_block, observed,
         cast(cast('0x' || substr(md5((case when row_key % 4 <> 0 then parcel else row_key end) || '_7'), 1, 8) as bigint) % 5 as int) as fold
  from tx
)"""
)

PART = """
parts as (
  select p_partkey, p_brand, p_type, p_retailprice,
         case when p_size > 5 then cast(p_size as double) end as size
  from part
)"""

LINES = """
price_lines as (
  select l_orderkey, sum(l_quantity) as quantity, sum(l_extendedprice) / 1e5 as price,
         cast(cast('0x' || substr(md5(l_orderkey || '_3'), 1, 8) as bigint) % 5 as int) as fold
  from lineitem group by l_orderkey
),
fits as (
  select f.fold, regr_slope(price, quantity) as slope, regr_intercept(price, quantity) as base
  from price_lines p join (select distinct fold from price_lines) f on p.fold <> f.fold
  group by f.fold
)"""

CELLS = """
cells as (
  select l_orderkey, sum(l_quantity) > 100 as much, count(*) > 4 as many, sum(l_extendedprice) / 1e5 as price
  from lineitem group by l_orderkey
),
base as (select median(price) as base from cells),
middles as (select much, many, median(price) as middle, count(*) as n from cells group by much, many)"""

NAMES = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey")
CORRELATIONS = """
folded as (
  select *, cast('0x' || substr(md5(l_orderkey || '_1'), 1, 8) as bigint) % 5 as fold from lineitem
),
importance as (
""" + "\n  union all\n".join(
    f"  select '{n}' as feature, cast(f.fold as int) as fold, "
    f"abs(corr(cast({n} as double), l_extendedprice)) as importance\n"
    f"  from folded l join (select distinct fold from folded) f on l.fold <> f.fold group by f.fold"
    for n in NAMES
) + "\n)"

HORIZONS = (34, 35, 36, 46, 47, 48)
PERIODS = ("199710", "199711", "199712", "199810", "199811", "199812")

KNOWN = (
    TX
    + """,
horizons as (select unnest(["""
    + ", ".join(map(str, HORIZONS))
    + """]) as horizon),
last_sale as (
  select horizon, parcel, month_block, observed,
         row_number() over (partition by horizon, parcel order by dt desc, row_key desc) as back
  from horizons join tx on month_block < horizon
),
known as (
  select c_custkey as parcel, h.horizon, l.month_block as prev_month, l.observed as prev_logerror,
         h.horizon - l.month_block as month_interval,
         case when l.observed is not null then 1 else 0 end as has_history
  from customer cross join horizons h
  left join last_sale l on l.parcel = c_custkey and l.horizon = h.horizon and l.back = 1
)"""
)

SUBMISSION = (
    "with "
    + TX
    + """,
monthly as (
  select parcel, year || lpad(cast(month as varchar), 2, '0') as yyyymm, avg(logerror) as prediction
  from tx group by parcel, year, month
)
select parcel, """
    + ", ".join(f"round_even(max(case when yyyymm = '{p}' then prediction end), 4) as \"{p}\"" for p in PERIODS)
    + " from monthly group by parcel"
)


def _stat_columns(keys: str, value: str, within: str = "") -> str:
    """Mean, difference and ratio of one value for one key set, as window expressions."""
    parts = keys.split(", ")
    name = "_".join(parts)
    whole = ", ".join([*([within] if within else []), *parts])
    known = " and ".join(f"{k} is not null" for k in parts)
    mean = f"(case when {known} then avg({value}) over (partition by {whole}) end)"
    return (
        f"round({mean}, 6) as {name}_{value}_mean, "
        f"round({mean} - {value}, 6) as {name}_{value}_dif, "
        f"round(({mean} - {value}) / nullif({mean}, 0), 6) as {name}_{value}_ratio"
    )


def _part_stats(*key_sets: str) -> str:
    columns = ", ".join(_stat_columns(k, v) for k in key_sets for v in ("p_retailprice", "size"))
    return f"with {PART} select p_partkey, p_brand, p_type, p_retailprice, size, {columns} from parts"


def _clip(x: str) -> str:
    return f"case when {x} is not null then round(least(1e0, greatest(-1e0, {x})), 6) end"


def _code(column: str, relation: str) -> str:
    """Rank of a text among the distinct texts of a relation, missing as ``nan``."""
    return (
        f"(select cast(count(distinct coalesce(o.{column}, 'nan')) as int) from {relation} o "
        f"where coalesce(o.{column}, 'nan') < coalesce(t.{column}, 'nan'))"
    )


LINEAR_SUBMISSION = (
    f"with {TX},"
    + """
horizons as (select unnest([46, 47, 48, 58, 59, 60]) as horizon),
lagged as (select *, lag(observed) over (partition by parcel order by dt, row_key) as prev from tx),
later as (select row_key, least(1e0, greatest(-1e0, observed)) as y, prev,
          cast(cast('0x' || substr(md5(row_key || '_11'), 1, 8) as bigint) % 5 as int) as fold
          from lagged where month_block > 3 and observed is not null),
fill as (select min(prev) - 1 as low from later),
fits as (select f.fold, regr_slope(y, coalesce(prev, low)) as slope, regr_intercept(y, coalesce(prev, low)) as base
         from later t join (select distinct fold from later) f on t.fold <> f.fold, fill group by f.fold),
line as (select avg(slope) as slope, avg(base) as base from fits),
ranked as (
  select horizon, parcel, observed, row_number() over (partition by horizon, parcel order by dt desc, row_key desc) as back
  from horizons join tx on month_block < horizon),
scored as (
  select c_custkey as parcel, h.horizon, base + slope * coalesce(r.observed, low) as prediction
  from customer cross join horizons h left join (select * from ranked where back = 1) r
    on r.parcel = c_custkey and r.horizon = h.horizon, line, fill)
select parcel as "ParcelId", """
    + ", ".join(
        f"round_even(max(case when horizon = {h} then prediction end), 4) as \"{p}\""
        for h, p in zip((46, 47, 48, 58, 59, 60), ("199810", "199811", "199812", "199910", "199911", "199912"), strict=True)
    )
    + " from scored group by parcel"
)


def _recipe(fold_key: str) -> str:
    """Clipped later sales with a filled feature, hashed folds, and one line per fold."""
    return f"""{TX},
        lagged as (select *, lag(observed) over (partition by parcel order by dt, row_key) as prev from tx),
        later as (select row_key, least(1e0, greatest(-1e0, observed)) as y, prev,
                  cast(cast('0x' || substr(md5({fold_key} || '_11'), 1, 8) as bigint) % 5 as int) as fold
                  from lagged where month_block > 3 and observed is not null),
        filled as (select row_key, y, fold, coalesce(prev, (select min(prev) - 1 from later)) as x from later),
        fits as (select f.fold, regr_slope(y, x) as slope, regr_intercept(y, x) as base
                 from filled t join (select distinct fold from filled) f on t.fold <> f.fold group by f.fold)"""


# The feature job, step by step.

STAT_KEYS = (
    "regionidcounty",
    "regionidcity",
    "regionidcounty, propertycountylandusecode",
    "regionidcity, propertycountylandusecode",
)
STAT_VALUES = ("yearbuilt", "taxamount_log")
YEAR_MONTHS = ((1998, 10, 46), (1998, 11, 47), (1998, 12, 48), (1999, 10, 58), (1999, 11, 59), (1999, 12, 60))


def _repair(name: str) -> str:
    low = f"(select least(min(a.{name}), min(b.{name})) - 1 from listed a left join second_list b using (parcelid))"
    return (
        f"coalesce(a.{name}, b.{name}, {low}) as {name}_1, coalesce(b.{name}, a.{name}, {low}) as {name}_2"
    )


def _collapsed(name: str) -> str:
    few = f"select {name} from long_list where snapshot_year = 1998 and {name} is not null group by {name} having count(*) < 60"
    return f"case when {name} in ({few}) then (select min({name}) from ({few})) else {name} end as {name}"


def _stat_ctes() -> tuple[str, str]:
    """One grouped table per key set, and the joins and columns that attach them."""
    ctes, joins = [], []
    for i, keys in enumerate(STAT_KEYS):
        parts = keys.split(", ")
        means = ", ".join(f"avg({v}) as {v}_m" for v in STAT_VALUES)
        present = " and ".join(f"{k} is not null" for k in parts)
        ctes.append(
            f"stat{i} as (select snapshot_year, {keys}, {means} from score where {present} group by snapshot_year, {keys})"
        )
        match = " and ".join(f"s{i}.{k} = t.{k}" for k in ["snapshot_year", *parts])
        joins.append(f"left join stat{i} s{i} on {match}")
    return ",\n".join(ctes), "\n".join(joins)


def _stat_selects() -> list[str]:
    out = []
    for i, keys in enumerate(STAT_KEYS):
        name = "_".join(keys.split(", "))
        for v in STAT_VALUES:
            m = f"s{i}.{v}_m"
            out += [
                f"{m} as {name}_{v}_mean",
                f"{m} - t.{v} as {name}_{v}_dif",
                f"({m} - t.{v}) / nullif({m}, 0) as {name}_{v}_ratio",
            ]
    return out


def _stat_names() -> list[str]:
    return [s.split(" as ")[1] for s in _stat_selects()]


PROPERTY_COLUMNS = (
    "regionidcounty",
    "regionidcity",
    "propertycountylandusecode",
    "bathroomcnt",
    "yearbuilt",
    "taxamount_log",
)

FEATURES = (
    "with "
    + TX
    + """,
places as (select customer.*, n_regionkey from customer left join nation on n_nationkey = c_nationkey),
listed as (
  select c_custkey as parcelid, n_regionkey as regionidcounty,
         case when c_acctbal >= 0 then c_nationkey end as regionidcity,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as propertycountylandusecode,
         case when c_acctbal > 500 then cast(floor(c_acctbal / 1000) as bigint) end as bathroomcnt,
         case when c_acctbal < 9900 then c_acctbal end as taxamount,
         1900 + floor(c_acctbal / 100) as yearbuilt
  from places
),
second_list as (
  select c_custkey as parcelid, n_regionkey as regionidcounty,
         case when c_acctbal < 9000 then c_nationkey end as regionidcity,
         case when c_mktsegment <> 'FURNITURE' then c_mktsegment end as propertycountylandusecode,
         case when c_acctbal > 2500 then cast(floor(c_acctbal / 1000) as bigint) + 1 end as bathroomcnt,
         case when c_acctbal > 100 then c_acctbal * 1.25e0 end as taxamount,
         1901 + floor(c_acctbal / 100) as yearbuilt
  from places where c_acctbal > -900
),
repaired as (
  select a.parcelid, """
    + ",\n         ".join(_repair(n) for n in ("regionidcounty", "regionidcity", "bathroomcnt"))
    + """,
         a.propertycountylandusecode as use_1, b.propertycountylandusecode as use_2,
         a.taxamount as tax_1, b.taxamount as tax_2, a.yearbuilt as built_1, b.yearbuilt as built_2
  from listed a left join second_list b using (parcelid)
),
long_list as (
"""
    + "\n  union all\n".join(
        f"  select parcelid, {year} as snapshot_year, regionidcounty_{i} as regionidcounty, regionidcity_{i} as regionidcity,"
        f" use_{i} as propertycountylandusecode, bathroomcnt_{i} * 10 as bathroomcnt, built_{i} as yearbuilt,"
        f" case when tax_{i} + 0.1e0 > 0 then ln(tax_{i} + 0.1e0) end as taxamount_log from repaired"
        for i, year in ((1, 1998), (2, 1999))
    )
    + """
),
properties as (
  select parcelid, snapshot_year, regionidcounty, """
    + ", ".join(_collapsed(n) for n in ("regionidcity", "propertycountylandusecode"))
    + """, bathroomcnt, yearbuilt, taxamount_log from long_list
),
codes as (
  select use_text, row_number() over (order by use_text) - 1 as code
  from (select distinct coalesce(propertycountylandusecode, 'nan') as use_text from properties)
),
score as (
  select p.* replace (cast(code as int) as propertycountylandusecode)
  from properties p join codes on use_text = coalesce(propertycountylandusecode, 'nan')
),
sold as (
  select row_key as row_id, parcel, dt, year, month, month_block, observed as logerror,
         case when year <= 1998 then 1998 else 1999 end as snapshot_year,
         ntile(5) over (order by dt, row_key) - 1 as fold,
         lag(month_block) over (partition by parcel order by dt, row_key) as prev_month,
         lag(observed) over (partition by parcel order by dt, row_key) as prev_logerror
  from tx
),
train as (
  select s.*, """
    + ", ".join(PROPERTY_COLUMNS)
    + """
  from sold s left join score p on p.parcelid = s.parcel and p.snapshot_year = s.snapshot_year
),
"""
    + _stat_ctes()[0]
)

ENCODING = "regionidcity_propertycountylandusecode_logerror_enc"
_COUNTED = [f"t.{c}" for c in PROPERTY_COLUMNS]


def _missing(names: list[str]) -> str:
    return " + ".join(f"case when {n} is null then 1 else 0 end" for n in names)


def _rounded_columns(names: list[str]) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


FEATURES_TRAIN = (
    FEATURES
    + ",\nstats as (select t.*, "
    + ", ".join(_stat_selects())
    + " from train t "
    + _stat_ctes()[1]
    + """)
select parcel as "ParcelId", row_id, year, month, month_block, round(logerror, 6) as logerror,
       cast(prev_month as double) as prev_month, round(prev_logerror, 6) as prev_logerror,
       cast(month_block - prev_month as double) as month_interval,
       case when prev_logerror is not null then 1 else 0 end as has_history,
       regionidcounty, regionidcity, propertycountylandusecode, bathroomcnt,
       """
    + _rounded_columns(["yearbuilt", "taxamount_log", *_stat_names()])
    + ",\n       "
    + _missing(["logerror", *PROPERTY_COLUMNS, *_stat_names()])
    + """ as num_of_nan,
       round((select avg(o.logerror) from train o
              where o.fold <> t.fold and o.regionidcity is not distinct from t.regionidcity
                and o.propertycountylandusecode is not distinct from t.propertycountylandusecode), 6) as """
    + ENCODING
    + "\nfrom stats t"
)

FEATURES_SCORE = (
    FEATURES
    + ",\nstats as (select t.*, "
    + ", ".join(_stat_selects())
    + " from score t "
    + _stat_ctes()[1]
    + """),
ends as (
  select * from (values """
    + ", ".join(f"({y}, {m}, {h})" for y, m, h in YEAR_MONTHS)
    + """) v(snapshot_year, month, horizon)
),
last_sale as (
  select parcel, e.snapshot_year, e.month, e.horizon, s.month_block, s.logerror,
         row_number() over (partition by parcel, e.horizon order by dt desc, row_id desc) as back
  from sold s join ends e on s.month_block < e.horizon
),
known as (
  select parcel, snapshot_year, """
    + ", ".join(
        f"max(case when month = {m} then month_block end) as prev_month_{m}, "
        f"max(case when month = {m} then logerror end) as prev_logerror_{m}, "
        f"max(case when month = {m} then horizon - month_block end) as month_interval_{m}"
        for m in (10, 11, 12)
    )
    + """
  from last_sale where back = 1 group by parcel, snapshot_year
)
select t.parcelid as "ParcelId", t.snapshot_year, """
    + ", ".join(
        f"cast(prev_month_{m} as double) as prev_month_{m}, round(prev_logerror_{m}, 6) as prev_logerror_{m}, "
        f"cast(month_interval_{m} as double) as month_interval_{m}, "
        f"case when prev_logerror_{m} is not null then 1 else 0 end as has_history_{m}"
        for m in (10, 11, 12)
    )
    + """,
       regionidcounty, regionidcity, propertycountylandusecode, bathroomcnt,
       """
    + _rounded_columns(["yearbuilt", "taxamount_log", *_stat_names()])
    + ",\n       "
    + _missing([*PROPERTY_COLUMNS, *_stat_names()])
    + """ as num_of_nan,
       round(coalesce((select avg(o.logerror) from train o
              where o.regionidcity is not distinct from t.regionidcity
                and o.propertycountylandusecode is not distinct from t.propertycountylandusecode),
              (select avg(logerror) from train)), 6) as """
    + ENCODING
    + """
from stats t left join known k on k.parcel = t.parcelid and k.snapshot_year = t.snapshot_year"""
)


ORACLE_SQL: dict[str, str] = {
    "log_error_calendar": f"""with {TX}
        select row_key, parcel, year, month, day, month_block, round(logerror, 6) as logerror from tx""",
    "log_columns": """select c_custkey,
        case when c_acctbal + 0.1e0 > 0 then round(ln(c_acctbal + 0.1e0), 6) end as c_acctbal_log from customer""",
    "winsorize": f"""with {TX} select row_key, {_clip("logerror")} as clipped,
        {_clip("observed")} as clipped_observed from tx""",
    "scale_columns": f"""with {SNAPSHOTS}
        select parcelid,
               coalesce(regionid, regionid_2, (select least(min(regionid), min(regionid_2)) - 1 from wide)) * 10 as regionid,
               coalesce(regionid_2, regionid, (select least(min(regionid), min(regionid_2)) - 1 from wide)) * 10 as regionid_2
        from wide""",
    "composite_key": f"""with {SNAPSHOTS}
        select parcelid, coalesce(cast(regionid as varchar), 'nan') || '_' || coalesce(usecode_2, 'nan') as key_text
        from wide""",
    "round_half_even": f"with {TX} select row_key, round_even(logerror, 4) as rounded from tx",
    "null_count": f"""with {SNAPSHOTS} select parcelid, {
        _missing(["regionid", "balancecnt", "usecode", "regionid_2", "balancecnt_2", "usecode_2"])
    } as num_of_nan from wide""",
    "move_to_end": f"""with {TX} select row_key, parcel, year, month, month_block, round(logerror, 6) as logerror,
        5 as month_block_at, 2 as logerror_at from tx""",
    "select_columns": f"""with {SNAPSHOTS} select parcelid, cast(regionid as double) as regionid_x,
        round(balancecnt, 6) as balancecnt_x, usecode as usecode_x from first_list""",
    "narrow_types": """select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber
        from lineitem""",
    "align_snapshots": f"""with {SNAPSHOTS} select parcelid, cast(regionid as double) as regionid,
        round(balancecnt, 6) as balancecnt, usecode, cast(regionid_2 as double) as regionid_2, round(balancecnt_2, 6) as balancecnt_2, usecode_2 from wide""",
    "align_snapshots_full": f"""with {SNAPSHOTS}
        select coalesce(b.parcelid, a.parcelid) as parcelid, cast(b.regionid as double) as regionid, round(b.balancecnt, 6) as balancecnt, b.usecode,
               cast(a.regionid as double) as regionid_2, round(a.balancecnt, 6) as balancecnt_2, a.usecode as usecode_2
        from second_list b full join first_list a on a.parcelid = b.parcelid""",
    "split_snapshots": f"""with {SNAPSHOTS}
        select parcelid, cast(regionid as double) as regionid, round(balancecnt, 6) as balancecnt, usecode, 1 as source from wide
        union all select parcelid, regionid_2, round(balancecnt_2, 6), usecode_2, 2 from wide""",
    "stack_snapshots": f"""with {SNAPSHOTS}
        select parcelid, snapshot_year, cast(regionid as double) as regionid, round(balancecnt, 6) as balancecnt, usecode from stacked""",
    "cross_fill": f"""with {SNAPSHOTS},
        filled as (select *, coalesce(regionid, regionid_2) as r1, coalesce(regionid_2, regionid) as r2,
                   coalesce(balancecnt, balancecnt_2) as b1, coalesce(balancecnt_2, balancecnt) as b2 from wide),
        low as (select least(min(r1), min(r2)) - 1 as r, least(min(b1), min(b2)) - 1 as b from filled)
        select parcelid, coalesce(r1, r) as regionid, round(coalesce(b1, b), 6) as balancecnt, usecode,
               coalesce(r2, r) as regionid_2, round(coalesce(b2, b), 6) as balancecnt_2, usecode_2
        from filled cross join low""",
    "attach_property": f"""with {SNAPSHOTS}, {TX}
        select t.row_key, t.parcel, t.snapshot_year, cast(s.regionid as double) as regionid, round(s.balancecnt, 6) as balancecnt, s.usecode
        from (select *, case when year <= 1998 then 1998 else 1999 end as snapshot_year from tx) t
        left join stacked s on s.parcelid = t.parcel and s.snapshot_year = t.snapshot_year and s.balancecnt is not null""",
    "scoring_rows": """select c_custkey as parcel, y as year, m as month, (y - 1995) * 12 + m as month_block,
               cast(y as varchar) || cast(m as varchar) as yyyymm
        from customer, unnest([1998, 1999]) as ys(y), unnest([10, 11, 12]) as ms(m)""",
    "union_years": f"""with {TX}
        select row_key, parcel, round(logerror, 6) as logerror from tx where year <= 1997
        union all select row_key, parcel, null from tx where year > 1997""",
    "collapse_rare": """with sized as (
          select p_partkey, p_brand, case when p_brand <> 'Brand#7' then p_size end as p_size from part),
        paired as (select *, case when p_size > 25 then p_brand else 'Brand#99' end as p_brand_2 from sized),
        few as (select p_brand from paired group by p_brand having count(p_brand) < 75),
        few_sizes as (select p_size from paired where p_size is not null group by p_size having count(*) < 75)
        select p_partkey,
               case when p_brand in (from few) then (select min(p_brand) from few) else p_brand end as p_brand,
               cast(case when p_size in (from few_sizes) then (select min(p_size) from few_sizes) else p_size end as double) as p_size,
               case when p_brand_2 in (from few) then (select min(p_brand) from few) else p_brand_2 end as p_brand_2
        from paired""",
    "label_encode": f"""with {SNAPSHOTS},
        both_lists as (select parcelid, 1 as source, usecode from first_list
                       union all select parcelid, 2, usecode from second_list),
        codes as (select v, dense_rank() over (order by v) - 1 as code
                  from (select distinct coalesce(usecode, 'nan') as v from both_lists))
        select parcelid, source, cast(code as int) as usecode
        from both_lists join codes on v = coalesce(usecode, 'nan')""",
    "label_encode_names": """select p_partkey, cast(dense_rank() over (order by p_name) - 1 as int) as p_name,
        cast(dense_rank() over (order by p_type) - 1 as int) as p_type from part""",
    "group_stats_single": _part_stats("p_brand", "p_type"),
    "group_stats_pair": _part_stats("p_brand, p_type"),
    "group_stats_shuffled": _part_stats("p_brand", "p_type"),
    "group_stats_by_year": f"""with {SNAPSHOTS}
        select parcelid, snapshot_year, cast(regionid as double) as regionid, round(balancecnt, 6) as balancecnt, usecode, {
        ", ".join(_stat_columns(k, "balancecnt", "snapshot_year") for k in ("regionid", "usecode", "regionid, usecode"))
    } from stacked""",
    "group_stats_for_sales": f"""with {TX},
        worths as (select *, sqrt(c_acctbal + 1000) as worth from customer),
        stats as (select c_custkey, c_nationkey, c_mktsegment, worth as raw_worth, {
        ", ".join(_stat_columns(k, "worth") for k in ("c_nationkey", "c_nationkey, c_mktsegment"))
    } from worths)
        select row_key, parcel, stats.* exclude (c_custkey, raw_worth), round(raw_worth, 6) as worth from tx left join stats on c_custkey = parcel""",
    "contiguous_folds": f"""with {TX}
        select row_key, parcel, cast(ntile(5) over (order by dt, row_key) - 1 as int) as fold from tx""",
    "shuffled_folds": """select o_orderkey as row_key,
        cast(cast('0x' || substr(md5(o_orderkey || '_42'), 1, 8) as bigint) % 5 as int) as fold from orders""",
    "shuffled_folds_exact": """select o_orderkey as row_key,
        cast(ntile(7) over (order by md5(o_orderkey || '_42'), o_orderkey) - 1 as int) as fold from orders""",
    "group_folds": """select o_orderkey as row_key, o_custkey as parcel,
        cast(cast('0x' || substr(md5(o_custkey || '_7'), 1, 8) as bigint) % 5 as int) as fold from orders""",
    "group_folds_missing": f"""with {PARTLY_GROUPED} select row_key, fold from grouped""",
    "target_encode_group_folds": f"""with {PARTLY_GROUPED}
        select row_key, fold,
               round((select avg(o.observed) from grouped o where o.fold <> g.fold and o.month_block = g.month_block), 6) as others,
               round(coalesce(avg(observed) over (partition by month_block), avg(observed) over ()), 6) as everyone
        from grouped g""",
    "cv_group_oof": f"""with {PARTLY_GROUPED},
        known as (select * from grouped where observed is not null),
        fits as (select f.fold, regr_slope(observed, month_block) as slope, regr_intercept(observed, month_block) as base
                 from known k join (select distinct fold from known) f on k.fold <> f.fold group by f.fold)
        select row_key, k.fold, round(base + slope * month_block, 6) as prediction from known k join fits f on f.fold = k.fold""",
    "target_encode_oof": f"""with {SEGMENTED}
        select row_key, fold,
               round((select avg(o.observed) from folded o where o.fold <> f.fold and o.nation is not distinct from f.nation
                      and o.segment is not distinct from f.segment), 6) as nation_segment_observed_enc,
               round((select avg(o.observed) from folded o where o.fold <> f.fold and o.segment = f.segment), 6)
                 as segment_observed_enc
        from folded f""",
    "target_encode_region": f"""with {SEGMENTED},
        placed as (select row_key, n_regionkey as region, segment, observed,
                   cast(cast('0x' || substr(md5(row_key || '_5'), 1, 8) as bigint) % 7 as int) as fold
                   from segmented left join nation on n_nationkey = nation)
        select row_key, fold,
               round((select avg(o.observed) from placed o where o.fold <> p.fold and o.region is not distinct from p.region
                      and o.segment is not distinct from p.segment), 6) as region_segment_observed_enc
        from placed p""",
    "target_encode_apply": f"""with {SEGMENTED},
        keys as (select c_custkey, c_nationkey + case when c_acctbal > 5000 then 10 else 0 end as nation,
                        case when c_mktsegment <> 'MACHINERY' then c_mktsegment end as segment from customer)
        select c_custkey, nation, segment,
               round(coalesce((select avg(observed) from segmented s where s.nation is not distinct from k.nation
                               and s.segment is not distinct from k.segment),
                              (select avg(observed) from segmented)), 6) as nation_segment_observed_enc,
               round(coalesce((select avg(observed) from segmented s where s.segment = k.segment),
                              (select avg(observed) from segmented)), 6) as segment_observed_enc
        from keys k""",
    "sale_history": f"""with {TX},
        lagged as (select *, lag(month_block) over w as prev_month, lag(observed) over w as prev_logerror,
                   row_number() over w as sale_number from tx window w as (partition by parcel order by dt, row_key))
        select row_key, parcel, month_block, sale_number, cast(prev_month as double) as prev_month,
               round(prev_logerror, 6) as prev_logerror, cast(month_block - prev_month as double) as month_interval,
               case when prev_logerror is not null then 1 else 0 end as has_history from lagged""",
    "asof_history": f"""with {KNOWN}
        select parcel, horizon, cast(prev_month as double) as prev_month, round(prev_logerror, 6) as prev_logerror,
               cast(month_interval as double) as month_interval, has_history
        from known""",
    "horizon_rows_monthly": f"""with {KNOWN}
        select parcel, cast(1995 + (horizon - 1) // 12 as int) as year, cast((horizon - 1) % 12 + 1 as int) as month,
               cast(horizon as int) as month_block,
               (1995 + (horizon - 1) // 12) || lpad(cast((horizon - 1) % 12 + 1 as varchar), 2, '0') as yyyymm,
               cast(prev_month as double) as prev_month, round(prev_logerror, 6) as prev_logerror,
               cast(month_interval as double) as month_interval, has_history from known""",
    "asof_history_by_month": f"""with {KNOWN}
        select parcel, 1997 + (horizon - 34) // 12 as snapshot_year, {
        ", ".join(
            f"cast(max(case when (horizon - 1) % 12 = {m - 1} then prev_month end) as double) as prev_month_{m}, "
            f"round(max(case when (horizon - 1) % 12 = {m - 1} then prev_logerror end), 6) as prev_logerror_{m}, "
            f"cast(max(case when (horizon - 1) % 12 = {m - 1} then month_interval end) as double) as month_interval_{m}, "
            f"max(case when (horizon - 1) % 12 = {m - 1} then has_history end) as has_history_{m}"
            for m in (10, 11, 12)
        )
    } from known group by 1, 2""",
    "repeat_sale_pairs": f"""with {TX},
        placed as (select *, row_number() over (partition by parcel order by dt, row_key) as n,
                   row_number() over (partition by parcel, observed is null order by dt, row_key) as n_present from tx)
        select parcel, count(observed) as user_history,
               round(max(case when observed is not null and n_present = 1 then observed end), 6) as logerror_first,
               round(max(case when n = 2 then observed end), 6) as logerror_second
        from placed group by parcel having count(observed) > 1""",
    "sales_of_repeat_keys": f"""with {TX} select row_key, parcel, round(observed, 6) as observed from tx
        where parcel in (select parcel from tx group by parcel having count(observed) > 1)""",
    "dedup_within_31_days": f"""with {TX},
        gaps as (select *, datediff('day', lag(dt) over (partition by parcel order by dt, row_key), dt) as gap from tx)
        select row_key, parcel, round(logerror, 6) as logerror from gaps where gap is null or gap > 31""",
    "dedup_reasonable": f"""with {TX},
        gaps as (select *, datediff('day', lag(dt) over (partition by parcel order by dt, row_key), dt) as gap
                 from tx where abs(logerror) <= 1)
        select row_key, parcel, round(logerror, 6) as logerror from gaps where gap is null or gap > 31""",
    "target_profile": f"""with {TX}
        select count(observed) as n, round(avg(observed), 6) as mean, round(stddev_pop(observed), 6) as std,
               round(min(observed), 6) as low, round(max(observed), 6) as high,
               round(avg(case when observed is not null then case when abs(observed) < 0.2e0 then 1e0 else 0e0 end end), 6)
                 as share_inside from tx""",
    "target_histogram": f"""with {TX}
        select cast(case when observed < -1 then 0 when observed >= 1 then 41
                    else floor((observed + 1) * 40 / 2) + 1 end as int) as bucket, count(*) as n
        from tx where observed is not null group by 1""",
    "skew_profile": "\nunion all ".join(
        f"""select '{c}' as column_name,
        round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 5) as skewness
        from lineitem, (select avg({c}) as m from lineitem)"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "trim": f"with {TX} select row_key, round(observed, 6) as observed from tx where abs(observed) <= 1",
    "bucketed_history": f"""with {TX}, {SNAPSHOTS}
        select row_key, parcel, round(observed, 6) as observed,
               row_number() over (partition by parcel order by dt, row_key) as number,
               round(lag(observed) over (partition by parcel order by dt, row_key), 6) as prev_logerror,
               round(balancecnt, 6) as balancecnt, usecode
        from tx left join first_list on parcelid = parcel""",
    "read_quarantined": """with lines as (
          select o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as d,
                 k % 97 = 0 or k % 89 = 1 or k % 83 = 2 as malformed, k % 79 = 3 as keyless,
                 case when k % 79 = 3 then '' else cast(k as varchar) end || ',' || case when k % 97 = 0 then 'x' else '' end || c || ','
                   || case when k % 83 = 2 then '1995-13-45' else strftime(d, '%Y-%m-%d') end || case when k % 89 = 1 then ',extra' else '' end as line
          from orders),
        judged as (select *, case when malformed then 'malformed' when keyless then 'no row_key' else 'good' end as status from lines)
        select case when status = 'good' then k::double end as row_key, case when status = 'good' then c::double end as parcel,
               case when status = 'good' then strftime(d, '%Y-%m-%d') end as day, status, case when status <> 'good' then line end as text,
               count(*) filter (status = 'good') over () as good, count(*) filter (status <> 'good') over () as bad
        from judged""",
    "group_folds_balanced": """with recursive tx as (
          select o_orderkey as row_key, o_custkey as parcel, cast('0x' || substr(md5(o_custkey || '_7'), 1, 8) as bigint) % 1024 as bucket
          from orders),
        counts as (select parcel, bucket, count(*) as n from tx group by all),
        marked as (select *, n >= greatest(2, ceil(sum(n) over () / 1000)) as heavy from counts),
        things as (
          select n, 0 as kind, cast(parcel as varchar) as id from marked where heavy
          union all
          select sum(n), 1, lpad(cast(bucket as varchar), 6, '0') from marked where not heavy group by bucket),
        items as (select *, row_number() over (order by n desc, kind, id) as i from things),
        walk as (
          select 0 as i, 0::hugeint as a, 0::hugeint as b, 0::hugeint as c, 0::hugeint as d, 0::hugeint as e, -1 as fold
          union all
          select i, a + case when f = 0 then n else 0 end, b + case when f = 1 then n else 0 end, c + case when f = 2 then n else 0 end,
                 d + case when f = 3 then n else 0 end, e + case when f = 4 then n else 0 end, f
          from (select t.i, t.n, a, b, c, d, e, cast(list_position([a, b, c, d, e], least(a, b, c, d, e)) - 1 as int) as f
                from walk w join items t on t.i = w.i + 1)),
        placed as (select kind, id, fold from walk join items using (i))
        select row_key, parcel, fold from tx join marked using (parcel, bucket)
        join placed on kind = case when heavy then 0 else 1 end
          and id = case when heavy then cast(parcel as varchar) else lpad(cast(bucket as varchar), 6, '0') end""",
    "cv_ridge_moments": f"""with {LINES},
        m as (
          select p.penalty, f.fold, covar_pop(price, quantity) / (var_pop(quantity) + p.penalty) as slope, avg(price) as y, avg(quantity) as x
          from price_lines l join (select distinct fold from price_lines) f on l.fold <> f.fold, (values (0e0), (50e0)) p(penalty)
          group by p.penalty, f.fold)
        select penalty, m.fold, round(slope, 6) as slope, round(y - slope * x, 6) as base,
               round(avg(power(price - y - slope * (quantity - x), 2)) filter (l.fold <> m.fold), 6) as train_mse,
               round(avg(power(price - y - slope * (quantity - x), 2)) filter (l.fold = m.fold), 6) as valid_mse
        from m, price_lines l group by penalty, m.fold, slope, y, x""",
    "permutation_importance": """with o as (
          select l_orderkey, sum(l_quantity) as q, max(l_discount) as d, sum(l_extendedprice) / 1e5 as y,
                 row_number() over (order by l_orderkey) - 1 as p from lineitem group by l_orderkey),
        s as (select count(*) as n, var_pop(q) as qq, var_pop(d) as dd, covar_pop(q, d) as qd, covar_pop(q, y) as qy, covar_pop(d, y) as dy,
                     avg(q) as mq, avg(d) as md, avg(y) as my from o),
        w as (select *, (qy * dd - dy * qd) / (qq * dd - qd * qd) as wq, (dy * qq - qy * qd) / (qq * dd - qd * qd) as wd from s),
        moves as (
          select i, (select min(x) from range(h, h + 1000) t(x) where gcd(x, n) = 1) as a, offs % n as b, n
          from (select i, greatest(1, cast('0x' || substr(md5('4_' || i), 1, 8) as bigint) % 1048576) as h,
                       cast('0x' || substr(md5('4_' || i), 9, 8) as bigint) as offs from (values (0), (1)) v(i)), s),
        sent as (select (a * p + b) % n as p, max(case when i = 0 then q end) as q2, max(case when i = 1 then d end) as d2
                 from o, moves group by 1),
        e as (select avg(abs(y - my - wq * (q - mq) - wd * (d - md))) as own, avg(abs(y - my - wq * (q2 - mq) - wd * (d - md))) as eq,
                     avg(abs(y - my - wq * (q - mq) - wd * (d2 - md))) as ed from o join sent using (p), w)
        select 'quantity' as feature, round(own, 6) as loss, round(eq, 6) as permuted_loss, round(eq - own, 6) as importance from e
        union all select 'discount', round(own, 6), round(ed, 6), round(ed - own, 6) from e""",
    "dedup_since_kept": f"""with recursive {TX},
        numbered as (select *, row_number() over (partition by parcel order by dt, row_key) as n from tx),
        walk as (
          select parcel, n, row_key, logerror, dt as kept_dt, true as kept from numbered where n = 1
          union all
          select t.parcel, t.n, t.row_key, t.logerror, case when t.dt - w.kept_dt > 31 then t.dt else w.kept_dt end, t.dt - w.kept_dt > 31
          from walk w join numbered t on t.parcel = w.parcel and t.n = w.n + 1)
        select row_key, parcel, round(logerror, 6) as logerror from walk where kept""",
    "asof_rows": f"""with {TX},
        asked as (select row_key, parcel, dt - cast(row_key % 400 as int) as cutoff from tx),
        ranked as (
          select a.row_key, a.parcel, t.row_key as last_sale, t.observed,
                 row_number() over (partition by a.row_key order by t.dt desc, t.row_key desc) as back
          from asked a left join tx t on t.parcel = a.parcel and t.dt < a.cutoff)
        select row_key, parcel, cast(last_sale as double) as last_sale, round(observed, 6) as last_observed
        from ranked where back = 1""",
    "group_stats_as_of": f"""with {SEGMENTED},
        m as (select row_key, month_block, nation, segment, observed,
                avg(observed) over (partition by nation order by month_block range between unbounded preceding and 1 preceding) as a,
                case when segment is not null then
                  avg(observed) over (partition by nation, segment order by month_block range between unbounded preceding and 1 preceding) end as b
              from segmented)
        select row_key, month_block, nation, segment, round(observed, 6) as observed,
               round(a, 6) as nation_observed_mean, round(a - observed, 6) as nation_observed_dif,
               round((a - observed) / nullif(a, 0), 6) as nation_observed_ratio,
               round(b, 6) as nation_segment_observed_mean, round(b - observed, 6) as nation_segment_observed_dif,
               round((b - observed) / nullif(b, 0), 6) as nation_segment_observed_ratio from m""",
    "target_encode_as_of": f"""with {SEGMENTED},
        m as (select row_key, month_block, nation, segment,
                avg(observed) over (order by month_block range between unbounded preceding and 1 preceding) as o,
                case when segment is not null then
                  avg(observed) over (partition by segment order by month_block range between unbounded preceding and 1 preceding) end as a,
                avg(observed) over (partition by nation, segment order by month_block range between unbounded preceding and 1 preceding) as b
              from segmented)
        select row_key, month_block, nation, segment, round(coalesce(a, o), 6) as segment_observed_enc,
               round(coalesce(b, o), 6) as nation_segment_observed_enc from m""",
    "blend_models": """with o as (
          select l_orderkey, sum(l_quantity) as q, cast(count(*) as double) as c, max(l_extendedprice / 1e5) as d,
                 sum(l_extendedprice) / 1e5 as y,
                 cast(cast('0x' || substr(md5(l_orderkey || '_3'), 1, 8) as bigint) % 5 as int) as fold
          from lineitem group by l_orderkey),
        fits as (
          select f.fold, regr_slope(y, q) as qs, regr_intercept(y, q) as qi, regr_slope(y, c) as cs,
                 regr_intercept(y, c) as ci, regr_slope(y, d) as ds, regr_intercept(y, d) as di
          from o join (select distinct fold from o) f on o.fold <> f.fold group by f.fold),
        e as (select qi + qs * q - y as e1, ci + cs * c - y as e2, di + ds * d - y as e3 from o join fits using (fold)),
        g as (select avg(e1 * e1) as a, avg(e2 * e2) as b, avg(e3 * e3) as c, avg(e1 * e2) as ab, avg(e1 * e3) as ac, avg(e2 * e3) as bc from e),
        inner3 as (
          select *, (b * c - bc * bc) - (ab * c - bc * ac) + (ab * bc - b * ac) as u,
                 -(ab * c - ac * bc) + (a * c - ac * ac) - (a * bc - ab * ac) as v,
                 (ab * bc - ac * b) - (a * bc - ac * ab) + (a * b - ab * ab) as w from g),
        tries as (
          select 1e0 as x, 0e0 as y, 0e0 as z union all select 0e0, 1e0, 0e0 union all select 0e0, 0e0, 1e0
          union all select (b - ab) / (a + b - 2 * ab), (a - ab) / (a + b - 2 * ab), 0e0 from g
          union all select (c - ac) / (a + c - 2 * ac), 0e0, (a - ac) / (a + c - 2 * ac) from g
          union all select 0e0, (c - bc) / (b + c - 2 * bc), (b - bc) / (b + c - 2 * bc) from g
          union all select u / (u + v + w), v / (u + v + w), w / (u + v + w) from inner3),
        best as (
          select x, y, z from tries, g where x >= 0 and y >= 0 and z >= 0
          order by x * x * a + y * y * b + z * z * c + 2 * (x * y * ab + x * z * ac + y * z * bc) limit 1),
        means as (select avg(qs) as qs, avg(qi) as qi, avg(cs) as cs, avg(ci) as ci, avg(ds) as ds, avg(di) as di from fits)
        select l_orderkey, round(x * (qi + qs * q) + best.y * (ci + cs * c) + z * (di + ds * d), 6) as prediction
        from o, best, means""",
    "target_quantiles": f"""with {TX},
        p as (select unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])::double as probability),
        q as (select year, count(observed) as n,
                     quantile_cont(observed, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]) as v from tx group by year)
        select year, probability, n,
               round(v[list_position([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99], probability)], 6) as value from q, p""",
    "trim_quantiles": """with q as (select l_returnflag, quantile_cont(l_extendedprice, [0.01, 0.99]) as v from lineitem group by 1)
        select l_orderkey, l_linenumber, l.l_returnflag, round(l_extendedprice, 6) as l_extendedprice
        from lineitem l join q on q.l_returnflag = l.l_returnflag and l_extendedprice between v[1] and v[2]""",
    "boost_absolute": f"""with {CELLS}
        select l_orderkey, round(middle + (base - middle) * power(0.5, 4), 6) as prediction
        from cells join middles using (much, many), base""",
    "boost_absolute_rounds": f"""with {CELLS},
        rounds as (select cast(unnest([1, 2, 3, 4]) as int) as "round"),
        losses as (select "round", avg(abs(price - middle - (base - middle) * power(0.5, "round"))) as mae
                   from cells join middles using (much, many), base, rounds group by "round")
        select "round", n as "rows", round(0.5 * (middle - base) * power(0.5, "round" - 1), 6) as value, round(mae, 6) as mae
        from middles, base join losses on true""",
    "regression_metrics": f"""with {SEGMENTED},
        scored as (select fold, observed - avg(observed) over (partition by nation) as e from folded)
        select fold, count(e) as n, round(avg(abs(e)), 6) as mae, round(avg(e * e), 6) as mse,
               round(sqrt(avg(e * e)), 6) as rmse from scored group by fold""",
    "fold_summary": f"""with {SEGMENTED},
        scored as (select fold, observed - avg(observed) over (partition by nation) as e from folded),
        by_fold as (select fold, sqrt(avg(e * e)) as rmse from scored group by fold)
        select 'all' as split, round(avg(rmse), 6) as rmse_mean, round(stddev_pop(rmse), 6) as rmse_std from by_fold""",
    "score_sold_only": f"""with {KNOWN},
        scored as (select t.observed - k.prev_logerror as e from tx t join known k
                   on k.parcel = t.parcel and k.horizon = t.month_block)
        select count(e) as n, round(avg(abs(e)), 6) as mae, round(avg(e * e), 6) as mse,
               round(sqrt(avg(e * e)), 6) as rmse from scored""",
    "mean_importance": f"""with {CORRELATIONS}
        select feature, round(avg(importance), 6) as importance from importance group by feature""",
    "top_features": f"""with {CORRELATIONS},
        best as (select feature from importance group by feature order by avg(importance) desc, feature limit 3)
        select feature, fold, round(importance, 6) as importance from importance where feature in (from best)""",
    "cv_linear_metrics": f"""with {LINES}
        select f.fold, case when p.fold = f.fold then 'valid' else 'train' end as split, count(*) as n,
               round(avg(abs(price - base - slope * quantity)), 6) as mae,
               round(avg(power(price - base - slope * quantity, 2)), 6) as mse,
               round(sqrt(avg(power(price - base - slope * quantity, 2))), 6) as rmse
        from price_lines p cross join fits f group by 1, 2""",
    "cv_linear_oof": f"""with {LINES}
        select l_orderkey, p.fold, round(base + slope * quantity, 6) as prediction
        from price_lines p join fits f on f.fold = p.fold""",
    "ensemble_predict": f"""with {LINES}
        select l_orderkey, round(avg(base + slope * quantity), 6) as prediction
        from price_lines cross join fits group by l_orderkey""",
    "training_recipe": f"""with {_recipe("row_key")}
        select row_key, t.fold, round(y, 6) as logerror, round(base + slope * x, 6) as prediction
        from filled t join fits f on f.fold = t.fold""",
    "training_summary": f"""with {_recipe("parcel")},
        by_fold as (select f.fold, case when t.fold = f.fold then 'valid' else 'train' end as split,
                    avg(abs(y - base - slope * x)) as mae from filled t cross join fits f group by 1, 2)
        select split, round(avg(mae), 6) as mae_mean, round(stddev_pop(mae), 6) as mae_std from by_fold group by split""",
    "blend": """with o as (
          select l_orderkey, sum(l_quantity) as a, cast(count(*) as double) as b, sum(l_extendedprice) / 1e5 as y
          from lineitem group by l_orderkey),
        m as (select var_pop(a) as va, var_pop(b) as vb, covar_pop(a, b) as ab, covar_pop(a, y) as ay,
                     covar_pop(b, y) as cy, avg(a) as ma, avg(b) as mb, avg(y) as my from o),
        w as (select *, (ay * vb - cy * ab) / (va * vb - ab * ab) as wa, (cy * va - ay * ab) / (va * vb - ab * ab) as wb
              from m)
        select l_orderkey, round(my + wa * (a - ma) + wb * (b - mb), 6) as prediction from o cross join w""",
    "submission": SUBMISSION,
    "submission_csv": SUBMISSION,
    "features_round_trip": f"""with {SNAPSHOTS}
        select parcelid, snapshot_year, cast(regionid as double) as regionid, round(balancecnt, 6) as balancecnt, usecode from stacked""",
    "features_train": FEATURES_TRAIN,
    "features_score": FEATURES_SCORE,
    "job_from_csv": FEATURES_TRAIN,
    "linear_submission": LINEAR_SUBMISSION,
    "cv_gbt_metrics": f"""with {TX},
        later as (select cast(cast('0x' || substr(md5(row_key || '_42'), 1, 8) as bigint) % 3 as int) as fold
                  from tx where month_block > 3 and observed is not null)
        select f.fold, case when t.fold = f.fold then 'valid' else 'train' end as split, count(*) as n,
               true as better, true as within_limit
        from later t cross join (select distinct fold from later) f group by 1, 2""",
    "feature_importance": """select cast(unnest([0, 1, 2]) as int) as fold, cast(10 as bigint) as features, 1e0 as total, cast(1 as int) as least""",
    "gbt_submission": """select c_custkey as "ParcelId", cast(6 as int) as periods, true as near from customer""",
}
