"""The same queries in DuckDB SQL, written from common table expressions."""

from __future__ import annotations

import re

# the code points that Python's str.isspace accepts
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def rnd(x: str, n: int) -> str:
    """Half away from zero, by scaling."""
    s = f"1e{n}"
    return (
        f"(case when ({x}) < 0 then -cast(floor(-({x}) * {s} + 0.5) as bigint)"
        f" else cast(floor(({x}) * {s} + 0.5) as bigint) end / {s})"
    )


def pct(a: str, b: str, n: int) -> str:
    return rnd(f"100 * (({a}) / nullif({b}, 0) - 1)", n)


def ratio(a: str, b: str, n: int = 2) -> str:
    return rnd(f"100 * ({a}) / nullif({b}, 0)", n)


def mean(x: str) -> str:
    """From an exact decimal sum; the decimals are those of the number as it is written."""
    return f"(cast(cast(sum(cast(cast({x} as varchar) as decimal(38, 18))) as varchar) as double) / nullif(count({x}), 0))"


def code2(x: str) -> str:
    """Two digits at least."""
    return f"case when length(cast({x} as varchar)) < 2 then '0' || cast({x} as varchar) else cast({x} as varchar) end"


MIN_OBS = 10
MEMBER_ATTRIBUTES = (
    "member_code, member_iso_code, member_name, group_code, group_iso_code, group_name, "
    "is_single_member_group, is_autonomous"
)

# name -> (tables it reads, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (list(needs), body)


def sql(select: str, *needs: str) -> str:
    """The select with every expression it needs, directly or not, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return select
    return "with " + ",\n".join(f"{n} as (\n{CTES[n][1]}\n)" for n in ordered) + "\n" + select


cte(
    "mapping",
    f"""select {code2("n_nationkey")} as member_code,
       'M-' || {code2("n_nationkey")} as member_iso_code,
       replace(n_name, '_', ' ') as member_name,
       n_name as member_label,
       case when n_nationkey = 22 then 'SOLO' when n_nationkey in (23, 24) then 'SHARED' else r_name end as group_header,
       case n_nationkey when 22 then '06' when 23 then '07' when 24 then '08'
            else {code2("n_regionkey + 1")} end as group_code,
       'G-' || case n_nationkey when 22 then '06' when 23 then '07' when 24 then '08'
            else {code2("n_regionkey + 1")} end as group_iso_code,
       case when n_nationkey in (22, 23, 24) then n_name else r_name end as group_name,
       n_nationkey = 22 as is_single_member_group,
       n_nationkey in (23, 24) as is_autonomous
from nation join region on n_regionkey = r_regionkey""",
)
cte(
    "order_totals",
    f"""select {code2("c_nationkey")} as member_code,
       cast(year(o_orderdate) as bigint) as year, cast(quarter(o_orderdate) as bigint) as quarter,
       sum(cast(floor(o_totalprice * 1e2 + 0.5) as bigint)) as units, count(o_totalprice) as n
from orders join customer on o_custkey = c_custkey
group by 1, 2, 3""",
)
cte("calendar", "select distinct year, quarter from order_totals", "order_totals")

_VALUE = f"""case when coalesce(n, 0) >= {MIN_OBS} then {rnd("cast(units as double) / 1e2 / n", 1)} end as value,
       case when coalesce(n, 0) = 0 then 'no_data' when n < {MIN_OBS} then 'not_representative' end as value_flag"""

cte(
    "members",
    f"""select m.group_header, m.member_label, c.year, c.quarter,
       make_date(c.year, 3 * c.quarter - 2, 1) as quarter_start_date,
       {_VALUE}, m.is_single_member_group,
       'S' || cast(cast(floor((c.year - 1995) / 4) as bigint) as varchar) as source_sheet
from mapping m cross join calendar c
left join order_totals o on o.member_code = m.member_code and o.year = c.year and o.quarter = c.quarter""",
    "mapping", "calendar", "order_totals",
)
cte(
    "pooled",
    """select 'group' as geo_level, group_header, year, quarter, sum(units) as units, sum(n) as n
from order_totals join mapping using (member_code) group by 2, 3, 4
union all
select 'national', 'TOTAL', year, quarter, sum(units), sum(n) from order_totals group by 3, 4""",
    "order_totals", "mapping",
)
cte(
    "published",
    f"""select h.geo_level, h.group_header, c.year, c.quarter,
       make_date(c.year, 3 * c.quarter - 2, 1) as quarter_start_date, {_VALUE}
from (select distinct 'group' as geo_level, group_header from mapping union all select 'national', 'TOTAL') h
cross join calendar c
left join pooled p on p.geo_level = h.geo_level and p.group_header = h.group_header
     and p.year = c.year and p.quarter = c.quarter""",
    "mapping", "calendar", "pooled",
)
cte(
    "stacked",
    """select 'member' as geo_level, group_header, member_label, year, value, value_flag from members
union all
select geo_level, group_header, cast(null as varchar), year, value, value_flag from published""",
    "members", "published",
)
cte(
    "annual",
    f"""select geo_level, group_header, member_label, year,
       {rnd(mean("value"), 1)} as value_annual_mean,
       count(value) as periods_available,
       count(value) = 4 as is_complete_year,
       count(*) filter (where value_flag = 'not_representative') as periods_not_representative
from stacked group by 1, 2, 3, 4""",
    "stacked",
)
cte(
    "lookup",
    "select group_header, group_code, group_name from mapping where not is_autonomous group by all",
    "mapping",
)
# which rows of the annual table carry the series of which group
cte(
    "carriers",
    """select 'member' as geo_level, member_label as label, group_code, group_name, 'member_row' as value_source
from mapping where is_autonomous
union all select 'group', group_header, group_code, group_name, 'published_group' from lookup
union all select 'national', 'TOTAL', '00', 'National', 'published_total'""",
    "mapping", "lookup",
)
cte(
    "series",
    """select c.group_code, c.group_name, a.year, a.value_annual_mean as value, c.value_source, a.periods_available,
       a.is_complete_year
from annual a join carriers c on c.geo_level = a.geo_level and c.label = coalesce(a.member_label, a.group_header)""",
    "annual", "carriers",
)
cte(
    "member_years",
    """select m.group_code, m.is_single_member_group as single, m.is_autonomous as autonomous, a.year, a.value_annual_mean as v
from mapping m, annual a where a.member_label = m.member_label""",
    "annual", "mapping",
)
cte(
    "rollup_",
    f"""select group_code, year, {rnd(mean("v"), 1)} as member_simple_mean, count(*) as n_members, count(v) as n_members_with_data,
       min(single) as is_single_member_group, min(autonomous) as is_autonomous
from member_years group by all""",
    "member_years",
)
cte(
    "groups_",
    f"""select s.*, r.*, s.group_code = '00' as is_national
from series s, lateral (
  select {rnd(mean("v"), 1)} as member_simple_mean, nullif(count(*), 0) as n_members,
         case when count(*) > 0 then count(v) end as n_members_with_data,
         coalesce(min(single), false) as is_single_member_group, coalesce(min(autonomous), false) as is_autonomous
  from member_years y where y.group_code = s.group_code and y.year = s.year) r""",
    "series", "member_years",
)

_MEAN2 = "cast(sum({u}) as double) / 1e2 / nullif(sum({n}), 0)"
cte(
    "line_totals",
    f"""select {code2("s_nationkey")} as member_code, cast(year(l_shipdate) as bigint) as year,
       l_returnflag, sum(cast(floor(l_extendedprice * 1e2 + 0.5) as bigint)) as units, count(l_extendedprice) as n
from lineitem join supplier on l_suppkey = s_suppkey
where l_shipdate >= timestamp '1996-01-01' group by 1, 2, 3""",
)
cte(
    "line_levels",
    """select group_code, group_name, year, l_returnflag, units, n from line_totals join mapping using (member_code)
union all select '00', 'National', year, l_returnflag, units, n from line_totals""",
    "line_totals", "mapping",
)
cte(
    "line_means",
    f"""select group_code, group_name, year, 'General' as index_type,
       {_MEAN2.format(u="units", n="n")} as mean from line_levels group by 1, 2, 3
union all
select group_code, group_name, year, t.index_type,
       case when group_code not in ('07', '08') then
       {_MEAN2.format(u="case when l_returnflag = t.flag then units end", n="case when l_returnflag = t.flag then n end")}
       end
from line_levels cross join (values ('New dwelling', 'N'), ('Second-hand dwelling', 'R')) t(index_type, flag)
group by 1, 2, 3, 4""",
    "line_levels",
)
cte(
    "index_raw",
    f"""select a.group_code, a.group_name, a.index_type, 'Annual average index' as metric_type, a.year,
       {ratio("a.mean", "b.mean", 3)} as value
from line_means a left join line_means b on b.group_code = a.group_code and b.index_type = a.index_type and b.year = 2000
union all
select a.group_code, a.group_name, a.index_type, 'Annual variation', a.year, {pct("a.mean", "p.mean", 1)}
from line_means a left join line_means p
  on p.group_code = a.group_code and p.index_type = a.index_type and p.year = a.year - 1""",
    "line_means",
)
cte(
    "index_long",
    """select group_code, group_name, group_code = '00' as is_national,
       case index_type when 'General' then 'general' when 'New dwelling' then 'new'
            when 'Second-hand dwelling' then 'second_hand' end as index_type,
       case metric_type when 'Annual average index' then 'index'
            when 'Annual variation' then 'annual_variation_pct' end as metric_type,
       year, value
from index_raw""",
    "index_raw",
)
cte(
    "wide",
    """select group_code, year,
       max(case when index_type = 'general' and metric_type = 'index' then value end) as index_general,
       max(case when index_type = 'new' and metric_type = 'index' then value end) as index_new,
       max(case when index_type = 'second_hand' and metric_type = 'index' then value end) as index_second_hand,
       max(case when index_type = 'general' and metric_type = 'annual_variation_pct' then value end)
           as index_annual_variation_pct
from index_long group by 1, 2""",
    "index_long",
)
cte("trend_keys", "select group_code, year from wide union select group_code, year from groups_", "wide", "groups_")
cte(
    "joined",
    """select group_code, year, w.* exclude (group_code, year), g.* exclude (group_code, year)
from trend_keys left join wide w using (group_code, year) left join groups_ g using (group_code, year)""",
    "trend_keys", "wide", "groups_",
)
_BASED = ratio("j.value", "g0.value")
cte(
    "trend",
    f"""select j.group_code, (select max(x.group_name) from groups_ x where x.group_code = j.group_code) as group_name,
       (select max(x.group_iso_code) from mapping x where x.group_code = j.group_code) as group_iso_code,
       j.year, j.group_code = '00' as is_national,
       (select max(x.is_single_member_group) from groups_ x where x.group_code = j.group_code) as is_single_member_group,
       (select max(x.is_autonomous) from groups_ x where x.group_code = j.group_code) as is_autonomous, j.n_members,
       j.index_general, j.index_new, j.index_second_hand, j.index_annual_variation_pct,
       j.value, j.value_source, j.periods_available, j.is_complete_year, j.member_simple_mean,
       case when j.is_complete_year and p.is_complete_year then {pct("j.value", "p.value", 2)} end as value_yoy_pct,
       cast(1996 as bigint) as rebase_year, {ratio("j.index_general", "w0.index_general")} as index_rebased,
       case when j.is_complete_year then {_BASED} end as value_rebased,
       {rnd(f"case when j.is_complete_year then {_BASED} end - " + ratio("j.index_general", "w0.index_general"), 2)} as rebased_gap_pts
from joined j
left join wide w0 on w0.group_code = j.group_code and w0.year = 1996
left join groups_ g0 on g0.group_code = j.group_code and g0.year = 1996
left join groups_ p on p.group_code = j.group_code
     and p.year = (select max(k.year) from trend_keys k where k.group_code = j.group_code and k.year < j.year)""",
    "joined", "wide", "groups_", "trend_keys", "mapping",
)
cte(
    "full_years",
    "select member_label, year, value_annual_mean as v from annual where geo_level = 'member' and is_complete_year",
    "annual",
)
cte(
    "windows",
    f"""select {MEMBER_ATTRIBUTES}, a.v as value_base, b.v as value_recent_base, c.v as value_last,
       {pct("c.v", "a.v", 1)} as growth_pct, {rnd("100 * (pow(c.v / nullif(a.v, 0), 0.25e0) - 1)", 2)} as cagr_pct,
       {pct("c.v", "b.v", 1)} as growth_pct_recent
from mapping m
left join full_years a on a.member_label = m.member_label and a.year = 1996
left join full_years b on b.member_label = m.member_label and b.year = 1998
left join full_years c on c.member_label = m.member_label and c.year = 2000
where m.member_label in (select member_label from full_years)""",
    "mapping", "full_years",
)
cte(
    "group_growth",
    f"""select k.group_code, {pct("c.value", "a.value", 1)} as v_full, {pct("c.value", "b.value", 1)} as v_recent,
       {pct("c.index_general", "a.index_general", 1)} as i_full, {pct("c.index_general", "b.index_general", 1)} as i_recent
from (select group_code from trend group by 1) k
left join trend a on a.group_code = k.group_code and a.year = 1996
left join trend b on b.group_code = k.group_code and b.year = 1998
left join trend c on c.group_code = k.group_code and c.year = 2000""",
    "trend",
)
cte(
    "benchmarked",
    """select w.*, v_full as group_value_growth_pct, v_recent as group_value_growth_pct_recent,
       i_full as group_index_growth_pct, i_recent as group_index_growth_pct_recent,
       (select v_full from group_growth where group_code = '00') as national_value_growth_pct,
       (select i_full from group_growth where group_code = '00') as national_index_growth_pct
from windows w left join group_growth using (group_code)""",
    "windows", "group_growth",
)
_RANK = """case when growth_rank <= 5 then 'Top 5'
            when growth_rank > count(*) over () - 5 then 'Bottom 5' end as rank_group"""
cte(
    "summary",
    f"""select *, {_RANK} from (
  select x.*, cast(1996 as bigint) as base_year, cast(1998 as bigint) as recent_base_year, cast(2000 as bigint) as last_year,
         {rnd("x.growth_pct - x.group_value_growth_pct", 1)} as growth_vs_group_pp,
         {rnd("x.growth_pct - x.national_value_growth_pct", 1)} as growth_vs_national_pp,
         1 + (select count(*) from benchmarked o
              where o.growth_pct > x.growth_pct or x.growth_pct is null and o.growth_pct is not null) as growth_rank
  from benchmarked x)""",
    "benchmarked",
)
cte(
    "prior",
    f"""select q.*, p.value as value_prior_year, {pct("q.value", "p.value", 2)} as yoy_pct
from members q left join members p
  on p.member_label = q.member_label and p.year = q.year - 1 and p.quarter = q.quarter""",
    "members",
)
cte(
    "base_mean",
    "select member_label, value_annual_mean as base_value from annual where geo_level = 'member' and year = 1996",
    "annual",
)
cte(
    "member_trend",
    f"""select m.member_code, m.member_iso_code, m.member_name, q.member_label, m.group_code, m.group_iso_code,
       m.group_name, q.year, q.quarter, q.quarter_start_date, q.value, q.value_flag, q.value_prior_year, q.yoy_pct,
       cast(1996 as bigint) as rebase_year, {ratio("q.value", "b.base_value")} as index_rebased,
       m.is_single_member_group, m.is_autonomous,
       case when m.is_single_member_group then 'single' when m.is_autonomous then 'autonomous' else 'regular' end as member_note,
       s.growth_rank, s.rank_group
from prior q join mapping m using (member_label)
left join base_mean b on b.member_label = q.member_label
left join summary s on s.member_code = m.member_code""",
    "prior", "mapping", "base_mean", "summary",
)
cte(
    "header_turns",
    """select conv_id, turn, role, text,
       last_value(case when role = 'user' then turn end ignore nulls)
           over (partition by conv_id order by turn rows unbounded preceding) as header_turn
from conversations""",
)
LABEL = f"replace(trim(regexp_replace(text, '{WHITESPACE}+', ' ', 'g'), ' '), ' )', ')')"
cte(
    "active",
    "select distinct o_custkey as c_custkey, year(o_orderdate) as year from orders",
)
cte(
    "labelled",
    "select d.doc_id, d.lang, d.source, l.quality from documents d left join labels l on l.doc_id = d.doc_id",
)

RAW_INDEX = "select group_code, group_name, index_type, metric_type, year, value from index_raw"
GRID_MEMBERS = (
    "select group_header, member_label, year, quarter, value, is_single_member_group, value_flag, source_sheet from members"
)


cte(
    "faulty_members",
    """select m.* replace (case when member_label = 'NATION_3' and year = 1997 then null else member_label end as member_label,
       case when quarter = 4 then 'odd' else value_flag end as value_flag)
from members m, unnest(case when year = 1996 and quarter = 1 then [1, 2] else [1] end)""",
    "members",
)
cte(
    "faulty_mapping",
    """select * replace (case when member_label = 'NATION_6' then '07' else member_code end as member_code)
from mapping where member_label <> 'NATION_5'""",
    "mapping",
)
cte(
    "faulty_index",
    "select * replace (case when index_type <> 'new' then index_type end as index_type) from index_long",
    "index_long",
)


def _suite(faulty: bool = False) -> str:
    """Every check of the suite, or those of the inputs on faulty ones, with the number of failing rows."""
    tables = {
        "index": "index_long", "members": "members", "published": "published", "annual": "annual", "groups": "groups_",
        "trend": "trend", "member_trend": "member_trend", "summary": "summary", "mapping": "mapping",
    }
    names = "member_code member_iso_code member_name member_label"
    not_null = {
        "index": "group_code index_type metric_type year",
        "members": "group_header member_label year quarter",
        "published": "group_header year quarter",
        "annual": "geo_level group_header year",
        "groups": "group_code year",
        "trend": "group_code group_name year",
        "member_trend": "member_code member_name group_code year quarter",
        "summary": "member_code member_iso_code member_name growth_pct",
        "mapping": f"{names} group_header group_code group_iso_code group_name",
    }
    accepted = [
        ("index", "index_type", "'general', 'new', 'second_hand'"),
        ("index", "metric_type", "'index', 'annual_variation_pct'"),
        ("members", "quarter", "1, 2, 3, 4"),
        ("members", "value_flag", "'no_data', 'not_representative'"),
        ("published", "geo_level", "'national', 'group'"),
        ("member_trend", "rank_group", "'Top 5', 'Bottom 5'"),
    ]
    grains = {
        "index": "group_code, index_type, metric_type, year",
        "members": "member_label, year, quarter",
        "published": "group_header, year, quarter",
        "annual": "geo_level, group_header, member_label, year",
        "groups": "group_code, year",
        "trend": "group_code, year",
        "member_trend": "member_code, year, quarter",
        "mapping": "group_header, member_label",
    }
    failing: dict[str, str] = {}
    for table, columns in not_null.items():
        for column in columns.split():
            failing[f"{table}.{column} not null"] = f"select 1 from {tables[table]} where {column} is null"
    for table, column, values in accepted:
        failing[f"{table}.{column} accepted"] = f"select 1 from {tables[table]} where {column} not in ({values})"
    for table, columns in [("mapping", names), ("summary", "member_code member_iso_code")]:
        for column in columns.split():
            failing[f"{table}.{column} unique"] = (
                f"select {column} from {table} where {column} is not null group by 1 having count(*) > 1"
            )
    for table, columns in grains.items():
        failing[f"{table} grain"] = f"select 1 from {tables[table]} group by {columns} having count(*) > 1"
    failing["groups single member equal"] = (
        "select 1 from groups_ where (is_single_member_group or is_autonomous)"
        " and abs(coalesce(value, -1) - coalesce(member_simple_mean, -1)) > 0.001"
    )
    failing["trend base is 100"] = (
        "select 1 from trend where year = 1996 and (abs(index_rebased - 100) > 0.001 or abs(value_rebased - 100) > 0.001"
        " or index_rebased is null or value_rebased is null)"
    )
    for table, key in [("members", "member_label"), ("member_trend", "member_code")]:
        failing[f"{table} in mapping"] = (
            f"select distinct {key} from {table} where {key} is not null and {key} not in (select {key} from mapping)"
        )
    failing["mapping covered"] = (
        "select m.member_label from mapping m left join members q on q.member_label = m.member_label group by 1"
        " having count(distinct case when q.member_label is not null then (q.year, q.quarter) end)"
        " <> (select count(distinct (year, quarter)) from members)"
    )
    failing["hierarchy agrees"] = (
        "select distinct q.member_label, q.group_header, q.is_single_member_group from members q join mapping m"
        " on m.member_label = q.member_label where q.group_header <> m.group_header"
        " or q.is_single_member_group <> m.is_single_member_group"
    )
    failing["code sets equal"] = (
        "select * from (select distinct group_code from index_long where not is_national) i full outer join"
        " (select distinct group_code from mapping) m on i.group_code = m.group_code"
        " where i.group_code is null or m.group_code is null"
    )
    failing["trend coverage"] = (
        "select year from trend where year between 1996 and 2000 group by 1"
        " having count(*) <> 9 or count(index_general) <> 9 or count(value) <> 9"
    )
    needs = list(tables.values())
    shown = ""
    if faulty:
        inputs = {"members": "faulty_members", "mapping": "faulty_mapping", "index_long": "faulty_index", "published": "published"}
        failing = {n: b for n, b in failing.items() if not re.search(r"\b(annual|groups_|trend|member_trend|summary)\b", b)}
        failing = {n: re.sub(r"\b(members|mapping|index_long)\b", lambda m: inputs[m[0]], b) for n, b in failing.items()}
        needs, shown = list(inputs.values()), ", count(*) > 0 as has_sample"
    parts = [f"""select '{name}' as "check", count(*) as failing_rows{shown} from ({body})""" for name, body in failing.items()]
    return sql("\nunion all ".join(parts), *needs)


def oracle_sql() -> dict[str, str]:
    full = {
        "seed_mapping": "mapping",
        "stage_index_long": "index_long",
        "member_quarter": "members",
        "published_quarter": "published",
        "stack_levels": "stacked",
        "annualise": "annual",
        "group_lookup": "lookup",
        "published_series": "series",
        "simple_mean_rollup": "rollup_",
        "group_annual": "groups_",
        "index_pivot": "wide",
        "mart_trend_group": "trend",
        "growth_windows": "windows",
        "mart_growth_summary": "summary",
        "mart_trend_member": "member_trend",
    }
    out = {name: sql(f"select * from {table}", table) for name, table in full.items()}
    out["weighted_vs_simple"] = sql(
        f"select group_code, year, value, member_simple_mean, {pct('member_simple_mean', 'value', 1)} as simple_gap_pct"
        " from groups_ where member_simple_mean is not null",
        "groups_",
    )
    out["align_panels"] = sql(
        "select group_code, year, index_general, index_new, index_second_hand, index_annual_variation_pct, value,"
        " is_complete_year from joined",
        "joined",
    )
    out["gated_yoy"] = sql(
        f"select group_code, year, value, is_complete_year, case when is_complete_year and lag(is_complete_year) over w"
        f" then {pct('value', 'lag(value) over w', 2)} end as value_yoy_pct from groups_"
        " window w as (partition by group_code order by year)",
        "groups_",
    )
    base = "max(case when year = 1996 then value end) over (partition by group_code)"
    out["rebase_series"] = sql(
        f"select group_code, year, {ratio('value', base)} as value_rebased,"
        f" case when is_complete_year then {ratio('value', base)} end as value_rebased_complete from groups_",
        "groups_",
    )
    out["seasonal_yoy"] = sql(
        "select member_label, year, quarter, value, value_prior_year, yoy_pct from prior", "prior"
    )
    out["rebase_to_annual"] = sql(
        f"select q.member_label, q.year, q.quarter, q.value, {ratio('q.value', 'b.base_value')} as index_rebased"
        " from members q left join base_mean b on b.member_label = q.member_label",
        "members", "base_mean",
    )
    out["benchmark_growth"] = sql(
        "select member_code, group_code, group_value_growth_pct, group_value_growth_pct_recent, group_index_growth_pct,"
        " group_index_growth_pct_recent, national_value_growth_pct, national_index_growth_pct from benchmarked",
        "benchmarked",
    )
    out["rank_groups"] = f"""with totals as (
  select o_custkey, cast(sum(case when year(o_orderdate) = 1996 then cast(floor(o_totalprice * 1e2 + 0.5) as bigint) end) as double) as a,
         cast(sum(case when year(o_orderdate) = 2000 then cast(floor(o_totalprice * 1e2 + 0.5) as bigint) end) as double) as b
  from orders group by 1),
growth as (select c_custkey, {pct("b", "a", 1)} as growth_pct from customer left join totals on o_custkey = c_custkey)
select *, {_RANK} from (select *, rank() over (order by growth_pct desc nulls last) as growth_rank from growth)"""
    out["finding_spread"] = sql(
        f"""select {rnd("max(growth_pct) - min(growth_pct)", 1)} as spread_pp,
       {rnd(mean("case when rank_group = 'Top 5' then growth_pct end"), 1)} as top_mean_pct,
       {rnd(mean("case when rank_group = 'Bottom 5' then growth_pct end"), 1)} as bottom_mean_pct,
       count(*) filter (where growth_pct > national_value_growth_pct) as n_above_national, count(*) as n_members,
       median(growth_pct) as median_growth_pct
from summary""",
        "summary",
    )
    out["finding_group_gap"] = sql(
        f"""select group_code, group_name, max(group_value_growth_pct) as group_growth_pct,
       first(member_code order by growth_pct desc, member_code desc) as fastest_member, max(growth_pct) as fastest_growth_pct,
       first(member_code order by growth_pct, member_code) as slowest_member, min(growth_pct) as slowest_growth_pct,
       {rnd("max(growth_pct) - min(growth_pct)", 1)} as gap_pp
from summary where growth_pct is not null group by 1, 2""",
        "summary",
    )
    out["finding_source_lag"] = sql(
        f"""select g.group_code, g.i_full as index_growth_pct, g.v_full as value_growth_pct,
       {rnd("g.i_full - g.v_full", 1)} as lag_pp, t.rebased_gap_pts
from group_growth g left join trend t on t.group_code = g.group_code and t.year = 2000""",
        "group_growth", "trend",
    )

    # hierarchy by row order
    header = "last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding)"
    out["fill_header"] = (
        f"select conv_id, turn, role, {header} as header, role <> 'user' and ({header}) is null as is_orphan from conversations"
    )
    out["self_children"] = sql(
        "select conv_id, header_turn, 'self' as member from header_turns where header_turn is not null"
        " group by 1, 2 having count(*) filter (where role <> 'user') = 0",
        "header_turns",
    )
    out["number_members"] = sql(
        "select conv_id, turn, role, header_turn, row_number() over (partition by conv_id, header_turn order by turn)"
        " as position from header_turns where role <> 'user' and header_turn is not null",
        "header_turns",
    )
    out["block_cut"] = f"""select conv_id, turn, role from (
  select *, min(case when {LABEL} = '' or starts_with(text, 'Th') then turn end)
            over (partition by conv_id) as stop from conversations)
where stop is null or turn < stop"""
    out["tree_consistency"] = sql(
        """select t.conv_id as sheet, count(*) as n_rows, count(f.turn) as n_matching,
       (select count(*) from first_tree) as n_expected,
       count(*) = (select count(*) from first_tree) and count(f.turn) = (select count(*) from first_tree) as same_tree
from header_turns t left join first_tree f on f.turn = t.turn and f.role = t.role
     and coalesce(f.header_turn, -1) = coalesce(t.header_turn, -1)
group by 1""",
        "first_tree",
    )
    out["tree_vs_reference"] = sql(
        """select coalesce(f.header, m.group_header) as header, coalesce(f.member, m.member_label) as member,
       f.header is not null as in_found, m.group_header is not null as in_reference
from (select distinct r_name as header, n_name as member from customer join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey) f
full outer join mapping m on m.group_header = f.header and m.member_label = f.member
where f.header is null or m.group_header is null""",
        "mapping",
    )
    out["fill_period"] = sql(
        """select distinct 'S' || cast((year - 1995) // 4 as varchar) as sheet,
       2 + ((year - 1995) % 4) * 4 + quarter - 1 as col, year, quarter from calendar""",
        "calendar",
    )
    out["unpivot_wide"] = sql(
        """select y.member_label, y.year, q.quarter, m.value
from (select distinct member_label, year from members) y cross join (select unnest([1, 2, 3, 4])::bigint as quarter) q
left join members m on m.member_label = y.member_label and m.year = y.year and m.quarter = q.quarter""",
        "members",
    )
    out["hierarchical_grid"] = sql(GRID_MEMBERS, "members")
    out["load_and_reconcile"] = sql(GRID_MEMBERS, "members")
    out["grid_published"] = sql(
        "select geo_level, group_header, year, quarter, value, value_flag from published", "published"
    )
    out["grid_tree"] = sql(
        """select s.sheet, m.group_header as header, row_number() over (partition by s.sheet, m.group_header
       order by m.member_code) as position, m.member_label as member
from mapping m cross join (select distinct source_sheet as sheet from members) s""",
        "mapping", "members",
    )

    # a text no one knows in the first cell of both totals, no years in S1, SOLO written as AFRICA
    out["grid_errors"] = sql(
        """select source_sheet as sheet, 'unexpected cell' as error, cast(14 as bigint) as row, cast(2 as bigint) as col,
       'TOTAL' as detail from (select distinct source_sheet from members)
union all
select 'S1', 'quarter without year', null, 2 + ((year - 1995) % 4) * 4 + quarter - 1, cast(quarter as varchar)
from calendar where (year - 1995) // 4 = 1
union all
select source_sheet, 'repeated header', 14 + 1 + 5 + (select count(*) from mapping where group_header not in ('SOLO', 'SHARED')),
       null, 'AFRICA' from (select distinct source_sheet from members)""",
        "members", "calendar", "mapping",
    )

    # text and cells
    out["normalise_labels"] = f"select doc_id, {LABEL} as label from documents"
    out["alias_labels"] = """select p_partkey, case label when '(Brand#1)' then '(Brand#01)' when '(Brand#2)' then '(Brand#02)'
       else label end as label from (select p_partkey, '(' || p_brand || ')' as label from part)"""
    out["split_code_prefix"] = f"""select c_custkey, case when c_custkey % 3 = 0 then '00'
       else {code2("c_nationkey")} end as code, c_name as name from customer"""
    out["parse_locale_number"] = """select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as strict_value,
       case when o_orderstatus <> 'P' then o_totalprice end as lenient_value from orders"""
    out["decode_sentinels"] = """select event_id,
       case when event_type not in ('error', 'view', 'signup', 'purchase')
            then cast(printf('%.1f', value + 0.05e0) as double) end as value,
       case event_type when 'error' then 'not_representative' when 'view' then 'not_representative'
            when 'signup' then 'no_data' when 'purchase' then 'unexpected' end as value_flag
from events"""

    # profiles
    out["profile_categories"] = sql(
        "select lang, source, count(*) as n_rows, count(*) filter (where quality is null) as n_missing,"
        " min(doc_id) as first_period, max(doc_id) as last_period from labelled group by 1, 2",
        "labelled",
    )
    out["profile_missing"] = sql(
        "select value_flag, member_label, count(*) as n_missing, min(quarter_start_date) as first_period,"
        " max(quarter_start_date) as last_period from members where value is null group by 1, 2",
        "members",
    )
    out["profile_periods"] = sql(
        "select source_sheet, string_agg(cast(year as varchar), ',' order by year) as years"
        " from (select distinct source_sheet, year from members) group by 1",
        "members",
    )
    out["profile_unique"] = "select count(distinct lang) as n_lang, count(distinct source) as n_source from documents"
    out["profile_geographies"] = sql("select distinct group_code, group_name from index_long order by 1, 2", "index_long")

    # data quality
    out["dq_not_null"] = sql("select * from labelled where quality is null", "labelled")
    out["dq_unique"] = "select o_custkey, count(*) as n_rows from orders where o_custkey is not null group by 1 having count(*) > 1"
    out["dq_unique_combination"] = (
        "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1"
    )
    out["dq_accepted_values"] = (
        "select o_orderpriority, count(*) as n_rows from orders"
        " where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1"
    )
    out["dq_relationships"] = (
        "select doc_id, count(*) as n_rows from documents where doc_id is not null and doc_id not in"
        " (select doc_id from labels where doc_id is not null) group by 1"
    )
    out["dq_reverse_coverage"] = sql(
        "select c.c_custkey, count(a.c_custkey) as n_periods from customer c left join active a on a.c_custkey = c.c_custkey"
        " group by 1 having count(a.c_custkey) <> (select count(distinct year) from active)",
        "active",
    )
    out["dq_set_equality"] = """(select doc_id, true as in_left, false as in_right from documents
   where doc_id not in (select doc_id from labels where doc_id is not null) group by 1)
union all
(select doc_id, false, true from labels where doc_id not in (select doc_id from documents where doc_id is not null) group by 1)"""
    out["dq_domain"] = """select coalesce(l.s, r.s) as o_orderstatus, l.s is not null as in_left, r.s is not null as in_right
from (select distinct o_orderstatus as s from orders) l full outer join (values ('F'), ('O'), ('X')) r(s) on l.s = r.s
where l.s is null or r.s is null"""
    out["dq_hierarchy_agrees"] = sql(
        """select distinct q.member_label, q.group_header, q.is_single_member_group, m.group_name as mapped_header,
       m.is_single_member_group as mapped_flag
from members q join mapping m on m.member_label = q.member_label
where m.is_autonomous and q.group_header <> m.group_name""",
        "members", "mapping",
    )
    out["dq_single_member_equal"] = sql(
        "select group_code, year, value, member_simple_mean from groups_"
        " where abs(coalesce(value, -1) - coalesce(member_simple_mean, -1)) > 0.001",
        "groups_",
    )
    out["dq_base_is_100"] = sql(
        "select group_code, index_rebased, value_rebased from trend where year = 1998 and (abs(index_rebased - 100) > 0.001"
        " or abs(value_rebased - 100) > 0.001 or index_rebased is null or value_rebased is null)",
        "trend",
    )
    out["dq_panel_coverage"] = sql(
        "select year, count(*) as n_entities, count(index_general) as n_index_general, count(value) as n_value from trend"
        " where year between 1995 and 2000 group by 1"
        " having count(*) <> 9 or count(index_general) <> 9 or count(value) <> 9",
        "trend",
    )
    out["dq_anchor"] = sql(
        """select e.group_code, e.year, e.expected_value, w.index_general
from (values ('00', 2000, 100e0), ('00', 1999, 1e0), ('07', 2000, null), ('99', 2000, 5e0)) e(group_code, year, expected_value)
left join wide w on w.group_code = e.group_code and w.year = e.year
where coalesce(abs(w.index_general - e.expected_value) > 0.001, false)
   or (w.index_general is null) <> (e.expected_value is null)""",
        "wide",
    )
    out["dq_complete_grid"] = sql(
        "select count(*) as n_rows, count(distinct c_custkey) as n_members, count(distinct year) as n_periods from active"
        " having count(*) <> count(distinct c_custkey) * count(distinct year)",
        "active",
    )
    out["dq_sheet_count"] = (
        "select count(distinct conv_id) as n_sheets from conversations having count(distinct conv_id) <> 8"
    )
    out["dq_suite"] = _suite()
    out["dq_suite_faulty"] = _suite(faulty=True)
    names = ("same tree on every sheet", "groups with a single member", "member grain", "published grain", "members x periods")
    out["grid_suite"] = sql(
        """select 'sheet count' as "check", case when count(distinct source_sheet) <> 8 then 1 else 0 end as failing_rows from members
union all select 'layout', count(distinct source_sheet) from members
union all select 'reference tree', count(*) from mapping where member_label = 'NATION_3'
"""
        + "".join(f"union all select '{name}', 0\n" for name in names),
        "members", "mapping",
    )
    out["load_seed_mapping"] = sql("select * from mapping", "mapping")
    out["grid_sparse"] = sql(GRID_MEMBERS, "members")
    out["pipeline_marts"] = sql("select * from summary", "summary")
    out["index_suite"] = sql(
        """select 'number of geographies' as "check", case when count(distinct (group_code, group_name)) <> 9 then 1 else 0 end as failing_rows
from index_raw where group_code <> '07'
union all select 'index types', 2
union all select 'metric types', count(*) from (select 1 from index_raw where year = 1997 and group_code <> '07' limit 1)
union all select 'grain', count(*) from (
  select 1 from index_raw, unnest(case when year = 1999 then [1, 2] else [1] end)
  where group_code <> '07' group by group_code, index_type, case when year <> 1997 then metric_type end, year having count(*) > 1)""",
        "index_raw",
    )
    out["read_index_file"] = sql(RAW_INDEX, "index_raw")
    out["read_quoted_file"] = "select cast(doc_id as varchar) as doc_id, lang, source, text from documents"
    out["publish_snapshot"] = sql(
        """select p.group_header, p.year, p.quarter, p.value, any_value(n) as n_values from published p
left join (select group_header, year, quarter, count(value) as n from members group by all) m using (group_header, year, quarter)
where p.year >= 1996 group by all""",
        "published", "members",
    )
    out["reconcile_content"] = sql(
        """, swapped as (select * replace (case when year = 1997 and quarter = 1 and member_label = 'NATION_3' then 'NATION_4'
  when year = 1997 and quarter = 1 and member_label = 'NATION_4' then 'NATION_3' else member_label end as member_label) from members)
select (select count(*) from members) as n_sent, (select count(*) from swapped) as n_loaded, true as same_count
where exists (select * from members except all select * from swapped)""",
        "members",
    )
    out["profile_period_runs"] = sql(
        """select c_custkey, min(year) as first_period, max(year) as last_period, count(*) as n_periods
from (select *, year - row_number() over (partition by c_custkey order by year) as run from active) group by c_custkey, run""",
        "active",
    )
    out["dq_unique_keys"] = """
select 'line' as "check", count(*) as failing_rows from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'order', count(*) from (select 1 from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1)
union all select 'part and supplier', count(*) from (select 1 from lineitem group by l_suppkey, l_partkey having count(*) > 1)
union all select 'order and part', count(*) from (select 1 from lineitem group by l_orderkey, l_partkey having count(*) > 1)"""
    out["exact_mean"] = EXACT_MEAN
    return out


# whole parts of values by powers of 2**60, added as big integers; the digits of the sum from the highest on give the double
EXACT_MEAN = """
with spread as (
  select event_type, case event_id % 4 when 0 then value * 1e25 when 1 then value * -1e25 when 2 then value * 1e-25 else value end as v from events),
placed as (select *, greatest(cast(floor(log2(nullif(abs(v), 0)) / 60) as integer), -6) as k from spread where v is not null),
cut as (select event_type, v, coalesce(k, 0) as k, abs(v) / pow(2.0, 60 * coalesce(k, 0)) as x from placed),
parts as (
  select event_type, k, sign(v) * floor(x) as part from cut
  union all select event_type, k - 1, sign(v) * (x - floor(x)) * pow(2.0, 60) from cut),
bins as (select event_type, k, sum(cast(part as hugeint)) as s from parts group by all),
filled as (
  select t.event_type, list(coalesce(b.s, 0::hugeint) order by k.k) as sums
  from (select distinct event_type from spread) t cross join range(-8, 5) k(k) left join bins b on b.event_type = t.event_type and b.k = k.k group by 1),
carried as (
  select event_type, sign, list_reduce(list_concat([{'c': 0::hugeint, 'd': []::hugeint[]}], list_transform(sums, lambda s: {'c': sign * s, 'd': []::hugeint[]})),
    lambda a, b: {'c': (b.c + a.c - ((b.c + a.c) % w + w) % w) // w, 'd': list_append(a.d, ((b.c + a.c) % w + w) % w)}) as r
  from filled, (select 1152921504606846976::hugeint as w), (values (1), (-1)) signs(sign)),
signed as (select event_type, sign, r.d as d, list_position(list_transform(list_reverse(r.d), lambda x: x > 0), true) as from_top from carried where r.c = 0),
topped as (select event_type, sign, d, len(d) + 1 - from_top as top from signed),
sums as (
  select event_type, case when top is null then 0.0 else sign * pow(2.0, 60 * (top - 1 - 9) - 1)
    * cast(cast(2 * (d[top] * 1152921504606846976::hugeint + d[top - 1])
      + case when list_sum(list_transform(d[1:top - 2], lambda x: cast(x > 0 as integer))) > 0 then 1 else 0 end as varchar) as double) end as total
  from topped)
select event_type, count(v) as n, any_value(total) / count(v) as mean from spread join sums using (event_type) group by event_type"""


cte(
    "first_tree",
    "select * from header_turns where conv_id = (select min(conv_id) from conversations)",
    "header_turns",
)
