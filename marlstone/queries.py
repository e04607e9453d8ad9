"""The engine's queries over the synthetic tables, in its dialect, and the same in standard SQL.

Each entry is named after what it shows. Where no standard text is given, the dialect's text is standard SQL already.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from marlstone.engine import Engine
from marlstone.functions.hashing import even_shards
from marlstone.sources.catalog import Catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
REFERENCE = ("region", "nation")


def engine(spark: SparkSession, sf_dir: str, **options: bool) -> Engine:
    catalog = Catalog(spark)
    for t in TABLES:
        catalog.add_frame(t, spark.read.parquet(f"{sf_dir}/{t}.parquet"), kind="reference" if t in REFERENCE else "unsharded")
    return Engine(spark, catalog, **options)


#: name: (dialect, standard or None)
TEXTS: dict[str, tuple[str, str | None]] = {
    # scans, routes, dual
    "scan_filter_topk": (
        "select l_returnflag, count(*) k, round(sum(l_quantity), 2) q from lineitem where l_discount < 0.05 group by l_returnflag order by k desc limit 0, 10",
        "select l_returnflag, count(*) k, round(sum(l_quantity), 2) q from lineitem where l_discount < 0.05 group by l_returnflag order by k desc limit 10",
    ),
    "dual_arithmetic": ("select 1+2 as a, 1-2 as b, 3*2 as c, 5/2 as d, -7 as e from dual", "select 1+2 as a, 1-2 as b, 3*2 as c, 2.5::double as d, -7 as e"),
    "division_by_zero_is_null": ("select o_orderkey, o_orderkey / (o_orderkey % 2) as a, o_orderkey % (o_orderkey % 3) as b, o_orderkey div (o_orderkey mod 2) as c from orders", "select o_orderkey, o_orderkey::double / nullif(o_orderkey % 2, 0) as a, o_orderkey % nullif(o_orderkey % 3, 0) as b, o_orderkey // nullif(o_orderkey % 2, 0) as c from orders"),
    "select_none": ("select o_orderkey, o_custkey from orders where o_custkey = null", "select o_orderkey, o_custkey from orders where false"),
    "not_in_null_is_empty": ("select o_orderkey from orders where o_custkey not in (1, null)", "select o_orderkey from orders where false"),
    "projection_star": ("select * from nation", None),
    "projection_qualified_star": ("select n.*, r.r_name from nation n join region r on n.n_regionkey = r.r_regionkey", None),
    "schema_qualified": ("select commerce.nation.n_name from commerce.nation where commerce.nation.n_nationkey < 5", "select n_name from nation where n_nationkey < 5"),
    "hex_literal": ("select n_name from nation where n_nationkey = 0x04", "select n_name from nation where n_nationkey = 4"),
    "quoting_and_comments": ("select `n_name` as \"name\" /* inner */ from nation where n_name <> \"x\" # end\n and n_nationkey < 3", "select n_name as name from nation where n_nationkey < 3"),
    "index_hints": ("select c_name from customer use index (pk) ignore index (a, b) for update", "select c_name from customer"),
    # predicates
    "filter_comparisons": ("select p_partkey from part where p_size != 5 and p_size <> 6 and p_size >= 3 and p_size < 40 and p_retailprice > 900 and not p_size <= 4", "select p_partkey from part where p_size <> 5 and p_size <> 6 and p_size >= 3 and p_size < 40 and p_retailprice > 900 and p_size > 4"),
    "filter_null_safe": ("select c_custkey from customer left join orders on c_custkey = o_custkey and o_totalprice > 250000 where o_orderkey <=> null", "select c_custkey from customer left join orders on c_custkey = o_custkey and o_totalprice > 250000 where o_orderkey is null"),
    "filter_and_or_xor": ("select p_partkey from part where (p_size > 25 xor p_retailprice > 1200) || false or p_size = 1 && p_brand like '%1'", "select p_partkey from part where (p_size > 25) <> (p_retailprice > 1200) or (p_size = 1 and p_brand like '%1')"),
    "filter_is": ("select c_custkey, c_acctbal is null as a, (c_acctbal > 0) is true as b, (c_acctbal > 0) is not false as c from customer", "select c_custkey, c_acctbal is null as a, (c_acctbal > 0) is true as b, (c_acctbal > 0) is not false as c from customer"),
    "filter_between": ("select l_orderkey, l_linenumber from lineitem where l_quantity between 10 and 12 and l_discount not between 0.02 and 0.08", None),
    "filter_in_list": ("select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_custkey not in (1, 2, 3)", None),
    "filter_tuple_in": ("select l_orderkey, l_linenumber from lineitem where (l_orderkey, l_linenumber) in ((1, 1), (2, 1), (3, 2))", None),
    "filter_like": ("select c_name from customer where c_name like 'Customer%1_' and c_name not like '%55%'", None),
    "filter_regexp": ("select c_name from customer where c_name regexp '[0-9]7$' and c_name not rlike '^x'", "select c_name from customer where regexp_matches(c_name, '[0-9]7$') and not regexp_matches(c_name, '^x')"),
    "filter_case": ("select c_custkey, case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 else 0 end as s, case when c_acctbal < 0 then 'debt' when c_acctbal = 0 then 'zero' end as k from customer", None),
    "filter_numeric_truth": ("select n_nationkey, if(n_regionkey, 'other', 'first') as k from nation where n_nationkey and !(n_regionkey)", "select n_nationkey, case when n_regionkey <> 0 then 'other' else 'first' end as k from nation where n_nationkey <> 0 and n_regionkey = 0"),
    "filter_bit_operators": ("select o_orderkey, o_orderkey & 7 as a, o_orderkey | 8 as b, o_orderkey ^ 3 as c, o_orderkey << 2 as d, o_orderkey >> 1 as e, ~o_orderkey as f from orders", "select o_orderkey, o_orderkey & 7 as a, o_orderkey | 8 as b, xor(o_orderkey, 3::bigint) as c, o_orderkey << 2 as d, o_orderkey >> 1 as e, ~o_orderkey as f from orders"),
    "filter_json": ("select event_id, props->>'$.k' as k, json_extract(props, '$.page') as p from events", "select event_id, props->>'$.k' as k, props->>'$.page' as p from events"),
    "filter_sounds_like": ("select c_custkey from customer where c_mktsegment sounds like 'bilding'", "select c_custkey from customer where c_mktsegment = 'BUILDING'"),
    "filter_collate": ("select c_custkey from customer where c_mktsegment collate utf8_general_ci = 'building'", "select c_custkey from customer where lower(c_mktsegment) = 'building'"),
    # joins
    "join_inner": ("select o_orderkey, c_name, o_totalprice from orders inner join customer on o_custkey = c_custkey where o_totalprice > 300000", None),
    "join_multi": ("select n_name, count(*) as orders, round(sum(o_totalprice), 2) as total from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey where r_name = 'ASIA' group by n_name", None),
    "join_comma": ("select n_name, r_name from nation, region where n_regionkey = r_regionkey and r_name < 'B'", None),
    "join_cross": ("select n_name, r_name from nation cross join region", None),
    "join_theta": ("select a.n_nationkey as x, b.n_nationkey as y from nation a join nation b on a.n_nationkey < b.n_nationkey and a.n_regionkey = b.n_regionkey", None),
    "join_left": ("select c_custkey, count(o_orderkey) as orders from customer left outer join orders on c_custkey = o_custkey and o_totalprice > 200000 group by c_custkey", None),
    "join_right": ("select o_orderkey, c_custkey from orders right join customer on o_custkey = c_custkey", None),
    "join_full": ("select n_nationkey, s_suppkey from nation full outer join supplier on n_nationkey = s_nationkey and s_acctbal > 5000", None),
    "join_semi": ("select c_custkey from customer left semi join orders on c_custkey = o_custkey and o_totalprice > 250000", "select c_custkey from customer where exists (select 1 from orders where c_custkey = o_custkey and o_totalprice > 250000)"),
    "join_anti": ("select c_custkey from customer left anti join orders on c_custkey = o_custkey and o_totalprice > 250000", "select c_custkey from customer where not exists (select 1 from orders where c_custkey = o_custkey and o_totalprice > 250000)"),
    "join_straight": ("select n_name, r_name from nation straight_join region on n_regionkey = r_regionkey", "select n_name, r_name from nation join region on n_regionkey = r_regionkey"),
    "join_natural": ("select a.n_name, b.cnt from nation a natural join (select n_nationkey, count(*) as cnt from nation group by n_nationkey) b", "select a.n_name, b.cnt from nation a join (select n_nationkey, count(*) as cnt from nation group by n_nationkey) b using (n_nationkey)"),
    "join_using": ("select doc_id, lang, toxic from documents join labels using (doc_id)", None),
    "join_self": ("select a.s_suppkey as a, b.s_suppkey as b from supplier a join supplier b on a.s_nationkey = b.s_nationkey and a.s_suppkey < b.s_suppkey", None),
    "join_where_over_left": ("select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey where o_orderkey is null or o_totalprice < 2000", None),
    "join_nested": ("select count(*) as n from customer left join (orders join lineitem on o_orderkey = l_orderkey) on c_custkey = o_custkey", None),
    "join_mixed_types": ("select count(*) as n from orders join customer on o_custkey = cast(c_custkey as char)", "select count(*) as n from orders join customer on o_custkey = c_custkey"),
    "join_large": ("select l_returnflag, o_orderpriority, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey group by l_returnflag, o_orderpriority", None),
    # subqueries
    "subquery_scalar": ("select o_orderkey from orders where o_totalprice > (select avg(o_totalprice) * 1.8 from orders)", None),
    "subquery_scalar_empty_is_null": ("select n_nationkey, (select r_name from region where r_regionkey = -1) as r from nation", None),
    "subquery_in_select_list": ("select n_nationkey, (select r_name from region where r_regionkey = n_regionkey) as r from nation", None),
    "subquery_in": ("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 250000)", None),
    "subquery_not_in": ("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 250000)", None),
    "subquery_not_in_empty": ("select n_nationkey from nation where n_regionkey not in (select r_regionkey from region where r_regionkey < 0)", None),
    "subquery_not_in_null": ("select n_nationkey from nation where n_regionkey not in (select nullif(r_regionkey, 1) from region)", None),
    "subquery_exists": ("select c_custkey from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F')", None),
    "subquery_not_exists": ("select s_suppkey from supplier where not exists (select * from lineitem where l_suppkey = s_suppkey and l_quantity > 49 and l_discount < 0.01)", None),
    "subquery_correlated_scalar": ("select c_custkey, (select max(o_totalprice) from orders where o_custkey = c_custkey) as m from customer", None),
    "subquery_any": ("select n_nationkey from nation where n_nationkey > any (select r_regionkey * 5 from region)", "select n_nationkey from nation where n_nationkey > (select min(r_regionkey * 5) from region)"),
    "subquery_all": ("select n_nationkey from nation where n_nationkey >= all (select r_regionkey * 5 from region)", "select n_nationkey from nation where n_nationkey >= (select max(r_regionkey * 5) from region)"),
    "subquery_eq_some_ne_all": ("select n_nationkey from nation where n_regionkey = some (select r_regionkey from region where r_name like 'A%') and n_nationkey <> all (select 3)", "select n_nationkey from nation where n_regionkey in (select r_regionkey from region where r_name like 'A%') and n_nationkey <> 3"),
    "derived_table": ("select cnt, count(*) as customers from (select o_custkey, count(*) as cnt from orders group by o_custkey) t group by cnt", None),
    "derived_union": ("select kind, count(*) as n from (select 'c' as kind, c_nationkey as k from customer union all select 's', s_nationkey from supplier) u group by kind", None),
    "cte": ("with big as (select o_custkey, sum(o_totalprice) as t from orders group by o_custkey), top as (select * from big where t > 500000) select c_name, round(t, 2) as t from top join customer on c_custkey = o_custkey", None),
    "cte_recursive": ("with recursive seq(n) as (select 1 union all select n + 1 from seq where n < 20) select n, n * n as square from seq", None),
    # aggregation
    "agg_scalar": ("select count(*) as n, count(o_custkey) as c, round(sum(o_totalprice), 2) as s, min(o_totalprice) as lo, max(o_orderdate) as hi, round(avg(o_totalprice), 4) as a from orders", None),
    "agg_scalar_empty": ("select count(*) as n, sum(l_quantity) as s, min(l_quantity) as lo, max(l_quantity) as hi from lineitem where l_quantity < 0", None),
    "agg_group": ("select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) as sum_charge, round(avg(l_quantity), 4) as avg_qty, count(*) as count_order from lineitem where l_shipdate <= date '1998-09-02' group by l_returnflag, l_linestatus", None),
    "agg_count_distinct": ("select l_returnflag, count(distinct l_suppkey) as s, count(distinct l_partkey, l_linenumber) as p from lineitem group by l_returnflag", "select l_returnflag, count(distinct l_suppkey) as s, count(distinct (l_partkey, l_linenumber)) as p from lineitem group by l_returnflag"),
    "agg_sum_distinct": ("select l_returnflag, sum(distinct l_linenumber) as s, min(distinct l_quantity) as lo, max(distinct l_quantity) as hi from lineitem group by l_returnflag", "select l_returnflag, sum(distinct l_linenumber)::bigint as s, min(l_quantity) as lo, max(l_quantity) as hi from lineitem group by l_returnflag"),
    "agg_all_null_group": ("select n_regionkey, sum(nullif(n_regionkey, n_regionkey)) as s, count(nullif(n_regionkey, n_regionkey)) as c from nation group by n_regionkey", "select n_regionkey, null::bigint as s, 0::bigint as c from nation group by n_regionkey"),
    "agg_bare_column": ("select n_regionkey, r_name, count(*) as n from nation join region on n_regionkey = r_regionkey group by n_regionkey", "select n_regionkey, any_value(r_name) as r_name, count(*) as n from nation join region on n_regionkey = r_regionkey group by n_regionkey"),
    "agg_alias_and_ordinal": ("select year(o_orderdate) as y, o_orderstatus, count(*) as n from orders group by y, 2", "select year(o_orderdate)::int as y, o_orderstatus, count(*) as n from orders group by 1, 2"),
    "agg_having": ("select o_custkey, count(*) as n from orders group by o_custkey having n > 15 and sum(o_totalprice) > 1000000", "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 15 and sum(o_totalprice) > 1000000"),
    "agg_having_without_group": ("select n_nationkey as k, n_name from nation having k > 20", "select n_nationkey as k, n_name from nation where n_nationkey > 20"),
    "agg_over_join": ("select r_name, count(distinct c_custkey) as c, round(sum(c_acctbal), 2) as s from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey group by r_name", None),
    "agg_complex_expression": ("select o_orderstatus, 1 + count(*) as a, round(sum(o_totalprice) / count(*) - min(o_totalprice), 2) as b from orders group by o_orderstatus", None),
    "agg_rollup": ("select l_returnflag, l_linestatus, count(*) as n from lineitem group by l_returnflag, l_linestatus with rollup", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by rollup(l_returnflag, l_linestatus)"),
    "agg_cube": ("select l_returnflag, l_linestatus, count(*) as n from lineitem group by l_returnflag, l_linestatus with cube", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by cube(l_returnflag, l_linestatus)"),
    "agg_grouping_sets": ("select l_returnflag, l_linestatus, count(*) as n from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())", None),
    "agg_group_concat": ("select n_regionkey, group_concat(n_name order by n_name desc separator ';') as g from nation group by n_regionkey", "select n_regionkey, string_agg(n_name, ';' order by n_name desc) as g from nation group by n_regionkey"),
    "agg_statistics": ("select l_returnflag, round(std(l_quantity), 6) as a, round(stddev(l_quantity), 6) as b, round(variance(l_quantity), 6) as c, round(var_pop(l_quantity), 6) as d, round(var_samp(l_quantity), 6) as e, round(stddev_samp(l_quantity), 6) as f from lineitem group by l_returnflag", "select l_returnflag, round(stddev_pop(l_quantity), 6) as a, round(stddev_pop(l_quantity), 6) as b, round(var_pop(l_quantity), 6) as c, round(var_pop(l_quantity), 6) as d, round(var_samp(l_quantity), 6) as e, round(stddev_samp(l_quantity), 6) as f from lineitem group by l_returnflag"),
    "agg_bits": ("select o_orderstatus, bit_and(o_orderkey) as a, bit_or(o_orderkey) as b, bit_xor(o_orderkey) as c from orders group by o_orderstatus", None),
    "agg_filter": ("select o_orderstatus, count(*) filter (where o_totalprice > 100000) as n from orders group by o_orderstatus", None),
    "distinct": ("select distinct o_orderstatus, o_orderpriority from orders", None),
    "distinct_on_join": ("select distinctrow r_name, c_mktsegment from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey", "select distinct r_name, c_mktsegment from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey"),
    # windows
    "window_ranking": ("select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as a, rank() over (partition by o_custkey order by o_orderstatus) as b, dense_rank() over (partition by o_custkey order by o_orderstatus) as c, ntile(3) over (partition by o_custkey order by o_orderkey) as d, round(percent_rank() over (partition by o_custkey order by o_orderkey), 6) as e, round(cume_dist() over (partition by o_custkey order by o_orderkey), 6) as f from orders", None),
    "window_offsets": ("select o_orderkey, lag(o_totalprice) over w as a, lead(o_totalprice, 2, 0) over w as b, first_value(o_orderkey) over w as c, last_value(o_orderkey) over w as d, nth_value(o_orderkey, 2) over w as e from orders window w as (partition by o_custkey order by o_orderkey)", None),
    "window_aggregates": ("select o_orderkey, count(*) over (partition by o_custkey) as n, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey), 2) as s from orders", None),
    "window_frames": ("select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between 2 preceding and current row), 2) as a, count(*) over (partition by o_custkey order by o_orderkey range between 100 preceding and 100 following) as b, max(o_orderkey) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding) as c from orders", None),
    # order, limit, sets
    "order_nulls_first": ("select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and o_totalprice > 300000 order by o_orderkey, c_custkey limit 20", "select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and o_totalprice > 300000 order by o_orderkey nulls first, c_custkey limit 20"),
    "order_expressions": ("select o_orderkey, o_totalprice from orders order by o_totalprice * -1, 1 limit 7", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 7"),
    "order_by_null": ("select n_name from nation order by null", "select n_name from nation"),
    "limit_offset": ("select o_orderkey from orders order by o_orderkey desc limit 10 offset 5", None),
    "limit_comma": ("select o_orderkey from orders order by o_orderkey limit 100, 25", "select o_orderkey from orders order by o_orderkey limit 25 offset 100"),
    "limit_beyond_end": ("select n_nationkey from nation order by n_nationkey limit 1000000, 10", "select n_nationkey from nation where false"),
    "topk_over_join": ("select l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, o_orderdate from customer, orders, lineitem where c_mktsegment = 'BUILDING' and c_custkey = o_custkey and l_orderkey = o_orderkey group by l_orderkey, o_orderdate order by revenue desc, l_orderkey limit 10", None),
    "union_all": ("select c_nationkey as k from customer union all select s_nationkey from supplier", None),
    "union_distinct": ("select c_nationkey as k from customer union select s_nationkey from supplier", None),
    "union_mixed": ("select c_nationkey as k from customer union select s_nationkey from supplier union all select n_nationkey from nation", None),
    "union_branches_limited": ("(select o_orderkey as k from orders order by o_orderkey limit 5) union all (select c_custkey from customer order by c_custkey desc limit 5)", None),
    "union_ordered": ("select n_nationkey as k from nation union all select r_regionkey from region order by k desc limit 8", None),
    "except_set": ("select c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 9000", None),
    "intersect_set": ("select c_nationkey as k from customer intersect select s_nationkey from supplier", None),
    "minus_set": ("select n_nationkey as k from nation minus select r_regionkey from region", "select n_nationkey as k from nation except select r_regionkey from region"),
    # functions
    "func_string_1": ("select c_custkey, concat(c_name, '-', c_mktsegment) as a, concat_ws('/', c_name, null, c_mktsegment) as b, ascii(c_mktsegment) as c, bin(c_custkey) as d, bit_length(c_name) as e, insert(c_name, 3, 2, 'XY') as f, insert(c_name, 0, 2, 'Q') as g, instr(c_name, 'o') as h, elt(2, 'a', c_name) as i, elt(9, 'a') as j from customer", "select c_custkey, c_name || '-' || c_mktsegment as a, concat_ws('/', c_name, null, c_mktsegment) as b, ascii(c_mktsegment) as c, bin(c_custkey) as d, bit_length(c_name) as e, substr(c_name, 1, 2) || 'XY' || substr(c_name, 5) as f, c_name as g, instr(c_name, 'o') as h, c_name as i, null::varchar as j from customer"),
    "func_string_2": ("select c_custkey, left(c_name, 4) as a, right(c_name, 3) as b, locate('o', c_name) as c, locate('0', c_name, 12) as d, lpad(c_mktsegment, 12, '*') as e, rpad(c_mktsegment, 4, '*') as f, ltrim('  x') as g, trim(leading 'C' from c_name) as h, mid(c_name, 2, 3) as i, substring(c_name from 4 for 2) as j, substr(c_name, -4) as k, substring(c_name, 0) as l from customer", "select c_custkey, left(c_name, 4) as a, right(c_name, 3) as b, instr(c_name, 'o') as c, case when instr(substr(c_name, 12), '0') = 0 then 0 else instr(substr(c_name, 12), '0') + 11 end as d, lpad(c_mktsegment, 12, '*') as e, rpad(c_mktsegment, 4, '*') as f, 'x' as g, ltrim(c_name, 'C') as h, substr(c_name, 2, 3) as i, substr(c_name, 4, 2) as j, substr(c_name, -4) as k, '' as l from customer"),
    "func_string_3": ("select doc_id, reverse(lang) as a, length(text) as b, char_length(text) as c, ucase(lang) as d, lcase(source) as e, hex(lang) as f, md5(source) as g, space(2) as h, replace(source, 'src', '#') as i, repeat(lang, 2) as j, char(77, 121) as k from documents", "select doc_id, reverse(lang) as a, strlen(text) as b, length(text) as c, upper(lang) as d, lower(source) as e, hex(lang) as f, md5(source) as g, '  ' as h, replace(source, 'src', '#') as i, repeat(lang, 2) as j, 'My' as k from documents"),
    "func_conditional": ("select n_nationkey, greatest(n_nationkey, n_regionkey) as a, least(n_nationkey, n_regionkey, 2) as b, greatest(n_nationkey, null) as c, isnull(nullif(n_regionkey, 1)) as d, if(n_nationkey > 10, 'hi', 'lo') as e, ifnull(nullif(n_regionkey, 1), -1) as f, coalesce(null, n_name) as g from nation", "select n_nationkey, greatest(n_nationkey, n_regionkey) as a, least(n_nationkey, n_regionkey, 2) as b, null::int as c, nullif(n_regionkey, 1) is null as d, if(n_nationkey > 10, 'hi', 'lo') as e, ifnull(nullif(n_regionkey, 1), -1) as f, n_name as g from nation"),
    "func_math": ("select n_nationkey, mod(n_nationkey, 4) as a, mod(n_nationkey, 0) as b, abs(-n_nationkey) as c, ceiling(n_nationkey / 2) as d, floor(n_nationkey / 2) as e, round(sqrt(n_nationkey), 6) as f, round(pow(n_nationkey, 2), 6) as g, round(log10(n_nationkey + 1), 6) as h, round(pi(), 6) as i, bit_count(n_nationkey) as j, sign(n_nationkey - 5) as k, truncate(n_nationkey / 7, 2) as l, acos(2) as m, sqrt(-1) as n, round(atan2(1, 2), 6) as o from nation", "select n_nationkey, n_nationkey % 4 as a, null::int as b, abs(-n_nationkey) as c, ceil(n_nationkey / 2)::bigint as d, floor(n_nationkey / 2)::bigint as e, round(sqrt(n_nationkey), 6) as f, round(pow(n_nationkey, 2), 6) as g, round(log10(n_nationkey + 1), 6) as h, round(pi(), 6) as i, bit_count(n_nationkey)::int as j, sign(n_nationkey - 5)::double as k, floor(n_nationkey / 7 * 100) / 100 as l, null::double as m, null::double as n, round(atan2(1, 2), 6) as o from nation"),
    "func_math_2": ("select n_nationkey, round(asin(n_nationkey / 25), 6) as a, round(atan(n_nationkey), 6) as b, round(cos(n_nationkey), 6) as c, round(sin(n_nationkey), 6) as d, round(tan(n_nationkey), 6) as e, round(ln(n_nationkey + 1), 6) as f, round(log(n_nationkey + 1), 6) as g, round(log(2, n_nationkey + 1), 6) as h, round(power(n_nationkey, 2), 6) as i, round(atan(n_nationkey, 3), 6) as j, rand() between 0 and 1 as k from nation", "select n_nationkey, round(asin(n_nationkey / 25), 6) as a, round(atan(n_nationkey), 6) as b, round(cos(n_nationkey), 6) as c, round(sin(n_nationkey), 6) as d, round(tan(n_nationkey), 6) as e, round(ln(n_nationkey + 1), 6) as f, round(ln(n_nationkey + 1), 6) as g, round(ln(n_nationkey + 1) / ln(2), 6) as h, round(pow(n_nationkey, 2), 6) as i, round(atan2(n_nationkey, 3), 6) as j, true as k from nation"),
    "func_string_4": ("select n_nationkey, len(n_name) as a, character_length(n_name) as b, cast(unhex(hex(n_name)) as char) as c, chr(65 + n_regionkey) as d, nil(n_name) is null as e, json_unquote('\"q\"') as f, json_unquote(n_name) as g, current_user() is not null as h, now() is not null as i, soundex('Robert') as j, soundex('Tymczak') as k from nation", "select n_nationkey, length(n_name)::int as a, length(n_name)::int as b, n_name as c, chr(65 + n_regionkey) as d, true as e, 'q' as f, n_name as g, true as h, true as i, 'R163' as j, 'T522' as k from nation"),
    "func_cast_2": ("select n_nationkey, cast(n_nationkey - 1 as unsigned) as a, cast(date_add('2024-01-31', interval 1 month) as date) as b, 2 = true as c, 1 = true as d from nation", "select n_nationkey, (case when n_nationkey = 0 then 18446744073709551615 else n_nationkey - 1 end)::decimal(20, 0) as a, date '2024-02-29' as b, false as c, true as d from nation"),
    "func_dates": ("select o_orderkey, year(o_orderdate) as a, month(o_orderdate) as b, extract(day from o_orderdate) as c, date_format(o_orderdate, '%Y-%m-%d') as d, datediff(o_orderdate, '1995-01-01') as e, cast(date_add(o_orderdate, interval 1 month) as date) as f, cast(o_orderdate - interval 3 day as date) as g, quarter(o_orderdate) as h, cast(last_day(o_orderdate) as date) as i from orders", "select o_orderkey, year(o_orderdate)::int as a, month(o_orderdate)::int as b, day(o_orderdate)::int as c, strftime(o_orderdate, '%Y-%m-%d') as d, date_diff('day', date '1995-01-01', o_orderdate::date)::int as e, (o_orderdate + interval 1 month)::date as f, (o_orderdate - interval 3 day)::date as g, quarter(o_orderdate)::int as h, last_day(o_orderdate) as i from orders"),
    "func_cast": ("select c_custkey, cast(c_custkey as char) as a, cast('12abc' as signed) as b, convert(c_acctbal, decimal(12, 1)) as c, cast(c_custkey as unsigned) as d, '3' + 4 as e, binary 'a' = 'a' as f from customer", "select c_custkey, c_custkey::varchar as a, 12::bigint as b, c_acctbal::decimal(12, 1) as c, c_custkey::decimal(20, 0) as d, 7 as e, true as f from customer"),
}


def _runner(text: str, **options: bool) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: engine(spark, sf_dir, **options).sql(text)


# queries that need more than a text


def mysql_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine(spark, sf_dir, mysql_compat=True).sql("select n_regionkey, avg(n_nationkey) as a from nation group by n_regionkey")


def bind_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine(spark, sf_dir).sql("select o_orderkey from orders where o_orderstatus = :s and o_totalprice > :p and o_custkey in ::keys", {"s": "O", "p": 100000.5, "keys": list(range(1, 60))})


def positional_binds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine(spark, sf_dir).sql("select o_orderkey from orders where o_orderstatus = ? and o_orderkey < ? order by o_orderkey limit ?", ["F", 3000, 12])


def multi_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = engine(spark, sf_dir).run_many("select 'nation' as t, count(*) as n from nation; select 'region' as t, count(*) as n from region")
    return first.unionByName(second)


def max_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine(spark, sf_dir).sql("select n_nationkey from nation order by n_nationkey", max_rows=7)


def split_engine(spark: SparkSession, sf_dir: str) -> Engine:
    """lineitem as a logical table of eight actual ones by its order key; orders as a sharded one."""
    from pyspark.sql import functions as F

    from marlstone.sources.store import PART

    e = engine(spark, sf_dir)
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n = 8
    e.catalog.add_split("items", {f"items_{i + 1}": lineitem.filter(F.abs("l_orderkey") % n == i) for i in range(n)}, "l_orderkey", "ShardTableByLong")
    from marlstone.functions.hashing import shard_column

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    shards = even_shards(4)
    e.catalog.add_sharded("sharded_orders", orders.withColumn(PART, shard_column(F.col("o_custkey"), shards)), "o_custkey", shards)
    return e


def split_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select l_orderkey, l_linenumber, l_quantity from items where l_orderkey = 7")


def split_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select l_returnflag, count(*) as n from items where l_orderkey in (1, 2, 3, 33, 97) group by l_returnflag")


def split_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select l_linestatus, count(*) as n, round(sum(l_quantity), 2) as q from items group by l_linestatus")


def shard_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select o_orderkey, o_totalprice from sharded_orders where o_custkey = 42")


def shard_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select o_orderkey from sharded_orders where (o_custkey = 1 or o_custkey = 2) and o_totalprice > 0")


def shard_scatter_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select c_mktsegment, count(*) as n from sharded_orders join customer on o_custkey = c_custkey group by c_mktsegment")


def shard_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each shard by its name; together they are the table."""
    e = split_engine(spark, sf_dir)
    out = [e.sql(f"/*shard={s}*/ select o_orderkey from sharded_orders") for s in even_shards(4)]
    for x in out[1:]:
        out[0] = out[0].unionByName(x)
    return out[0]


def scratch_path(spark: SparkSession) -> str:
    import uuid

    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/tables-{uuid.uuid4().hex}"


def dml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates, deletes, replaces and reads back."""
    e = engine(spark, sf_dir)
    e.catalog.create("acct", "id bigint, nation int, name string, balance double", scratch_path(spark), shard_key="id", shards=even_shards(4), primary_key=("id",))
    e.execute("insert into acct (id, nation, name, balance) select c_custkey, c_nationkey, c_name, c_acctbal from customer")
    e.execute("update acct set balance = 0, name = concat(name, '!') where nation = 3")
    e.execute("delete from acct where id in (1, 2, 3, 5, 8)")
    e.execute("insert into acct values (1, 1, 'new', 1.5), (100000001, 2, 'far', 2.5)")
    e.execute("replace into acct (id, nation, name, balance) values (4, 4, 'four', 4)")
    e.execute("insert into acct (id, nation, name, balance) values (6, 0, 'six', 1) on duplicate key update name = values(name), balance = balance + 1")
    e.execute("insert ignore into acct values (7, 0, 'ignored', 0)")
    return e.sql("select id, nation, name, round(balance, 2) as balance from acct")


def shard_decimal_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select o_orderkey, o_custkey from sharded_orders where o_custkey in (:a, :b, 44.0)", {"a": Decimal("42.00"), "b": 43.0})


def shard_string_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = split_engine(spark, sf_dir)
    return e.sql("select o_orderkey as k from sharded_orders where o_custkey = '42'").unionByName(e.sql("select l_orderkey as k from items where l_orderkey = 7.0"))


def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select o_orderstatus, count(*) as n from items join sharded_orders on l_orderkey = o_orderkey group by o_orderstatus")


def split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select l_orderkey as k from items where l_orderkey in (1, 7) union select o_orderkey from sharded_orders where o_custkey = 42")


def split_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_engine(spark, sf_dir).sql("select o_orderkey from orders where o_orderkey in (select l_orderkey from items where l_quantity > 49) and exists (select 1 from items where l_orderkey = o_orderkey and l_returnflag = 'R')")


def found_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = engine(spark, sf_dir)
    e.sql("select sql_calc_found_rows n_name from nation order by n_name limit 3")
    return e.sql("select found_rows() as n")


def account_engine(spark: SparkSession, sf_dir: str) -> Engine:
    e = engine(spark, sf_dir)
    e.catalog.create("acct", "id bigint, nation int, balance bigint", scratch_path(spark), shard_key="id", shards=even_shards(4), primary_key=("id",))
    e.execute("insert into acct select n_nationkey, n_regionkey, n_nationkey from nation")
    return e


def dml_on_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with one key inside a statement come one after the other; IGNORE keeps the first."""
    e = account_engine(spark, sf_dir)
    e.execute("insert into acct values (102, 1, 1), (102, 1, 5), (3, 1, 1), (102, 1, 7) on duplicate key update balance = balance * 2 + values(balance)")
    e.execute("insert ignore into acct values (103, 1, 1), (103, 2, 2), (4, 9, 9)")
    return e.sql("select id, nation, balance from acct")


def dml_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a transaction changed is undone by ROLLBACK and stays after COMMIT."""
    e = account_engine(spark, sf_dir)
    for text in ("begin", "delete from acct where id < 10", "insert into acct values (200, 0, 0)", "rollback", "begin", "update acct set balance = -1 where nation = 2", "commit", "rollback"):
        e.execute(text)
    return e.sql("select id, nation, balance from acct")


SPECIAL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "mysql_average_scale": (mysql_average, "select n_regionkey, round(avg(n_nationkey), 4)::decimal(38, 4) as a from nation group by n_regionkey"),
    "bind_variables": (bind_variables, "select o_orderkey from orders where o_orderstatus = 'O' and o_totalprice > 100000.5 and o_custkey between 1 and 59"),
    "positional_binds": (positional_binds, "select o_orderkey from orders where o_orderstatus = 'F' and o_orderkey < 3000 order by o_orderkey limit 12"),
    "multi_statement": (multi_statement, "select 'nation' as t, count(*) as n from nation union all select 'region', count(*) from region"),
    "max_rows": (max_rows, "select n_nationkey from nation order by n_nationkey limit 7"),
    "split_equal": (split_equal, "select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey = 7"),
    "split_in": (split_in, "select l_returnflag, count(*) as n from lineitem where l_orderkey in (1, 2, 3, 33, 97) group by l_returnflag"),
    "split_scatter": (split_scatter, "select l_linestatus, count(*) as n, round(sum(l_quantity), 2) as q from lineitem group by l_linestatus"),
    "shard_equal": (shard_equal, "select o_orderkey, o_totalprice from orders where o_custkey = 42"),
    "shard_or": (shard_or, "select o_orderkey from orders where o_custkey in (1, 2) and o_totalprice > 0"),
    "shard_scatter_join": (shard_scatter_join, "select c_mktsegment, count(*) as n from orders join customer on o_custkey = c_custkey group by c_mktsegment"),
    "shard_decimal_bind": (shard_decimal_bind, "select o_orderkey, o_custkey from orders where o_custkey in (42, 43, 44)"),
    "shard_string_key": (shard_string_key, "select o_orderkey as k from orders where o_custkey = 42 union all select l_orderkey from lineitem where l_orderkey = 7"),
    "split_join": (split_join, "select o_orderstatus, count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by o_orderstatus"),
    "split_union": (split_union, "select l_orderkey as k from lineitem where l_orderkey in (1, 7) union select o_orderkey from orders where o_custkey = 42"),
    "split_subquery": (split_subquery, "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 49) and exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')"),
    "found_rows": (found_rows, "select count(*)::int as n from nation"),
    "dml_on_duplicate": (dml_on_duplicate, "select n_nationkey::bigint as id, n_regionkey::int as nation, (case when n_nationkey = 3 then 7 else n_nationkey end)::bigint as balance from nation union all select 102, 1, 21 union all select 103, 1, 1"),
    "dml_rollback": (dml_rollback, "select n_nationkey::bigint as id, n_regionkey::int as nation, (case when n_regionkey = 2 then -1 else n_nationkey end)::bigint as balance from nation"),
    "shard_destinations": (shard_destinations, "select o_orderkey from orders"),
    "dml_round_trip": (
        dml_round_trip,
        """with base as (select c_custkey as id, c_nationkey as nation, case when c_nationkey = 3 then c_name || '!' else c_name end as name, case when c_nationkey = 3 then 0 else c_acctbal end as balance from customer where c_custkey not in (1, 2, 3, 4, 5, 8)),
        changed as (select id, nation, case when id = 6 then 'six' else name end as name, case when id = 6 then balance + 1 else balance end as balance from base)
        select id, nation, name, round(balance, 2) as balance from changed union all select 1, 1, 'new', 1.5 union all select 100000001, 2, 'far', 2.5 union all select 4, 4, 'four', 4""",
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: _runner(text) for n, (text, _) in TEXTS.items()} | {n: f for n, (f, _) in SPECIAL.items()}


def oracle_sql() -> dict[str, str]:
    return {n: standard or text for n, (text, standard) in TEXTS.items()} | {n: sql for n, (_, sql) in SPECIAL.items()}
