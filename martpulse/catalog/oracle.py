"""The same questions in plain SQL over the raw tables, written independently of the Spark plans."""

from __future__ import annotations

STARTUP = """startup as (
  select event_id, cast(user_id as varchar) as mid, cast(user_id as varchar) as uid, event_type as type, ts,
         strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour
  from events)"""

FIRST = STARTUP + """, ranked as (
  select *, row_number() over (partition by mid, log_date order by ts, event_id) as rn from startup),
first_login as (select * from ranked where rn = 1)"""

EVENT = """ev as (
  select event_id, cast(user_id % 10 as varchar) as mid, cast(user_id as varchar) as uid,
         case event_type when 'signup' then 'coupon' when 'click' then 'clickItem' when 'purchase' then 'addCart'
              when 'view' then 'addComment' else 'error' end as evid,
         regexp_extract(props, '([0-9]+)', 1) as itemid, ts
  from events)"""


def _windows(length: str, slide: str, copies: int) -> str:
    """Events copied into each window that holds them."""
    return EVENT + f""", win as (
  select ev.*, time_bucket(interval '{slide}', ts) - g.i * interval '{slide}' as window_start,
         time_bucket(interval '{slide}', ts) - g.i * interval '{slide}' + interval '{length}' as window_end
  from ev, range({copies}) g(i)),
alert as (
  select mid, window_start, window_end, count(distinct uid) filter (where evid = 'coupon') as uid_count
  from win group by mid, window_start, window_end
  having count(distinct uid) filter (where evid = 'coupon') >= 3
     and count(*) filter (where evid = 'clickItem') = 0)"""


HOUR_ALERTS = _windows("1 hour", "10 minutes", 6)

ALERT_DOCS = f"""with {HOUR_ALERTS}
select mid || '_' || cast(epoch_ms(window_end) // 60000 as varchar) as id, mid,
       array_to_string(list_sort(list(distinct uid) filter (where evid = 'coupon')), ',') as uids,
       array_to_string(list_sort(list(distinct itemid) filter (where evid = 'coupon')), ',') as "itemIds",
       array_to_string(list_sort(list(evid)), ',') as events,
       epoch_ms(window_end) as ts
from win join alert using (mid, window_start, window_end)
group by mid, window_end"""

ORDERS = """o as (
  select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as user_id, o_totalprice as total_amount,
         o_orderstatus as order_status, o_orderpriority as payment_way,
         strftime(o_orderdate, '%Y-%m-%d') as create_date,
         lpad(cast(o_orderkey % 24 as varchar), 2, '0') as create_hour,
         strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':'
           || lpad(cast(o_orderkey % 60 as varchar), 2, '0') || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0')
           as create_time,
         cast(c_nationkey as varchar) as province_id, c_name as consignee,
         '13' || lpad(cast(c_custkey as varchar), 9, '0') as consignee_tel, o_orderdate as order_ts
  from orders join customer on o_custkey = c_custkey)"""

DETAILS = """d as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id, cast(l_orderkey as varchar) as order_id,
         cast(l_partkey as varchar) as sku_id, p_name as sku_name, l_extendedprice as sku_price, l_shipdate as detail_ts
  from lineitem join part on l_partkey = p_partkey)"""

USERS = """u as (
  select cast(c_custkey as varchar) as id, c_name as login_name, cast(c_nationkey % 5 + 1 as varchar) as user_level,
         date '1965-01-01' + cast((c_custkey * 37) % 16000 as int) as birthday,
         case when c_custkey % 2 = 0 then 'M' else 'F' end as gender
  from customer)"""

SALES = f"""{ORDERS}, {DETAILS}, {USERS}, sale as (
  select d.id as order_detail_id, o.id as order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
         u.gender as user_gender,
         cast(coalesce(date_diff('day', u.birthday, date '2024-01-01') // 365, 0) as int) as user_age,
         u.user_level, d.sku_price, d.sku_name, o.create_date as dt, o.order_ts, d.detail_ts
  from o join d on d.order_id = o.id left join u on u.id = o.user_id)"""

WORDS = "[x for x in string_split_regex(lower(sku_name), '[^a-z0-9]+') if x <> '']"


def _hits(*wanted: str) -> str:
    tests = " and ".join(f"list_contains({WORDS}, '{w}')" for w in wanted)
    return f"{SALES}, hit as (select * from sale where {tests})"


RED_WIDGET = _hits("red", "widget")


def _score(*wanted: str) -> str:
    found = " + ".join(f"len([x for x in {WORDS} if x = '{w}'])" for w in wanted)
    return f"({found}) * 1.0 / len({WORDS})"


COUNTS = """n as (
  select count(*) as total, count(*) filter (where user_gender = 'M') as male,
         count(*) filter (where user_age < 20) as young, count(*) filter (where user_age >= 30) as aged
  from hit)"""


def _share(part: str) -> str:
    return f"coalesce(floor({part} * 1000.0 / nullif(total, 0) + 0.5) / 10, 0.0)"


def _two_days(rows: str, value: str) -> str:
    return f"""select lpad(cast(h.i as varchar), 2, '0') as hour,
       coalesce({value.format(day="y")}, 0) as yesterday, coalesce({value.format(day="t")}, 0) as today
from range(24) h(i) left join {rows} on r.hour = h.i group by h.i"""


SALE_FIELDS = """order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age, user_level,
       sku_price, sku_name, dt"""

EXPIRED_FIELDS = "order_detail_id, order_id, order_status, user_id, sku_id, sku_name, sku_price, dt"

CHANGE_VALUES = """order_img as (
  select json_object('id', cast(o_orderkey as varchar), 'user_id', cast(o_custkey as varchar),
           'order_status', o_orderstatus, 'total_amount', cast(o_totalprice as varchar),
           'create_time', strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(cast(o_orderkey % 24 as varchar), 2, '0')
             || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0') || ':'
             || lpad(cast(o_orderkey % 60 as varchar), 2, '0')) as value
  from orders),
line_img as (
  select json_object('id', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey),
           'order_id', cast(l_orderkey as varchar), 'sku_id', cast(l_partkey as varchar),
           'order_price', cast(l_extendedprice as varchar), 'sku_num', cast(cast(l_quantity as int) as varchar)) as value
  from lineitem),
user_img as (
  select g.up, json_object('id', id, 'login_name', login_name,
           'user_level', cast(cast(user_level as int) + g.up as varchar), 'birthday', cast(birthday as varchar),
           'gender', gender) as value
  from u, range(2) g(up)),
flat as (
  select 'order' as topic, cast(value as varchar) as value, 0 as pos from order_img
  union all select 'order_detail', cast(value as varchar), 0 from line_img
  union all select 'user_info', cast(value as varchar), 0 from user_img where up = 0
  union all select 'user_info', cast(value as varchar), up from user_img)"""

USER_LATEST = f"""with {USERS}
select id, login_name, cast(cast(user_level as int) + 1 as varchar) as user_level, cast(birthday as varchar) as birthday, gender
from u"""

DAILY_TURNOVER = f"""with {ORDERS}
select create_date, round(sum(total_amount), 2) as sum_amount from o group by create_date"""

SQL = {
    "q01_parse_startup": f"""with {STARTUP}
select mid, uid, type, epoch_us(ts) // 1000 as ts, log_date, log_hour from startup""",
    "q02_dau_total": """select strftime(ts, '%Y-%m-%d') as log_date, count(distinct user_id) as dau
from events group by 1""",
    "q02b_dau_of_day": """select count(distinct user_id) as dau from events
where cast(ts as date) = date '2024-01-15'""",
    "q03_dau_first_login": f"""with {FIRST}
select mid, uid, type, log_date, log_hour, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as first_ts
from first_login""",
    "q04_dau_hours": f"""with {FIRST}
select log_hour as hour, count(*) as value from first_login where log_date = '2024-01-15' group by log_hour""",
    "q04b_dau_hour_map": f"""with {FIRST}, h as (
  select log_hour, count(*) as n from first_login where log_date = '2024-01-15' group by log_hour)
select '{{' || string_agg('"' || log_hour || '":' || cast(n as varchar), ',' order by log_hour) || '}}' as hours from h""",
    "q05_dau_incremental": f"""with {FIRST}
select mid, log_date, cast(log_hour as int) as batch, event_id from first_login""",
    "q06_order_parse_mask": f"""with {ORDERS}
select id, province_id, consignee, cast(null as varchar) as order_comment,
       substr(consignee_tel, 1, 4) || '*********' as consignee_tel, order_status, payment_way, user_id,
       cast(null as varchar) as img_url, round(total_amount, 2) as total_amount, cast(null as varchar) as expire_time,
       cast(null as varchar) as delivery_address, create_time, cast(null as varchar) as operate_time,
       cast(null as varchar) as tracking_no, cast(null as varchar) as parent_order_id,
       cast(null as varchar) as out_trade_no, cast(null as varchar) as trade_body, create_date, create_hour
from o""",
    "q07_gmv_total": """select round(sum(o_totalprice), 2) as sum_amount from orders
where cast(o_orderdate as date) = date '1998-06-01'""",
    "q07b_gmv_daily": DAILY_TURNOVER,
    "q08_gmv_hours": f"""with {ORDERS}
select create_hour as hour, round(sum(total_amount), 2) as value from o where create_date = '1998-06-01'
group by create_hour""",
    "q09_hourly_compare_dau": f"""with {FIRST}
{_two_days("(select cast(log_hour as int) as hour, log_date from first_login where log_date in ('2024-01-14', '2024-01-15')) r",
           "count(*) filter (where log_date = {day})").replace("= y", "= '2024-01-14'").replace("= t", "= '2024-01-15'")}""",
    "q09b_hourly_compare_json": f"""with {FIRST}, h as (
  select log_date, log_hour, count(*) as n from first_login where log_date in ('2024-01-14', '2024-01-15') group by 1, 2),
m as (select log_date, '{{' || string_agg('"' || log_hour || '":' || cast(n as varchar), ',' order by log_hour) || '}}' as j
  from h group by log_date)
select '{{"yesterday":' || max(j) filter (where log_date = '2024-01-14') || ',"today":'
       || max(j) filter (where log_date = '2024-01-15') || '}}' as response from m""",
    "q10_hourly_compare_gmv": f"""with {ORDERS}
{_two_days("(select cast(create_hour as int) as hour, create_date, total_amount from o where create_date in ('1998-05-31', '1998-06-01')) r",
           "round(sum(total_amount) filter (where create_date = {day}), 2)").replace("= y", "= '1998-05-31'").replace("= t", "= '1998-06-01'")}""",
    "q11_coupon_alert": f"""with {HOUR_ALERTS}
select mid, strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') as window_end, uid_count
from alert""",
    "q12_alert_docs": ALERT_DOCS,
    "q12b_alert_per_minute": f"""with {_windows("1 hour", "30 seconds", 120)}
select mid || '_' || cast(epoch_ms(window_end) // 60000 as varchar) as id, mid,
       strftime(max(window_end), '%Y-%m-%d %H:%M:%S') as window_end
from alert group by 1, mid""",
    "q13_sale_detail": f"with {SALES} select {SALE_FIELDS} from sale",
    "q14_sale_detail_expiry": f"""with {SALES}
select {EXPIRED_FIELDS} from sale
where detail_ts between order_ts - interval '100 days' and order_ts + interval '100 days'""",
    "q14b_sale_detail_expiry_forward": f"""with {SALES}
select {EXPIRED_FIELDS} from sale where detail_ts between order_ts and order_ts + interval '100 days'""",
    "q15_unmatched_orders": """select cast(o_orderkey as varchar) as order_id, o_orderstatus as order_status,
       strftime(o_orderdate, '%Y-%m-%d') as dt, cast(o_custkey as varchar) as user_id
from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "q15b_full_outer": f"""with {ORDERS}, {DETAILS}
select coalesce(o.id, d.order_id) as order_id, d.id as order_detail_id, o.order_status, d.sku_price,
       case when o.id is null then 'detail_only' when d.id is null then 'order_only' else 'matched' end as status
from o full outer join d on d.order_id = o.id""",
    "q16_sale_search_page": f"""with {RED_WIDGET}
select order_detail_id, sku_name, user_gender, user_age, dt, round({_score("red", "widget")}, 6) as score
from hit order by score desc, order_detail_id limit 20 offset 20""",
    "q16b_sale_search_one_word": f"""with {_hits("widget")}
select order_detail_id, sku_name, round({_score("widget")}, 6) as score
from hit order by score desc, order_detail_id limit 100""",
    "q17_sale_search_total": f"with {RED_WIDGET} select count(*) as total from hit",
    "q17b_sale_search_total_day": f"""with {_hits("widget")}
select count(*) as total from hit where dt = '1998-06-01'""",
    "q17c_stored_search": f"""with {_hits("widget")}
select count(*) as total, count(*) filter (where user_gender = 'M') as male,
       count(*) filter (where user_age < 20) as young, count(*) filter (where user_age >= 30) as old
from hit where dt like '1998-06-%'""",
    "q18_terms_gender": f"with {RED_WIDGET} select user_gender as key, count(*) as doc_count from hit group by 1",
    "q19_terms_age_top10": f"""with {RED_WIDGET}
select user_age as key, count(*) as doc_count from hit group by 1 order by doc_count desc, key limit 10""",
    "q20_gender_share": f"""with {RED_WIDGET}, {COUNTS}
select '性别分布' as title, '男' as name, {_share("male")} as value from n
union all select '性别分布', '女', round(100 - {_share("male")}, 1) from n""",
    "q21_age_share": f"""with {RED_WIDGET}, {COUNTS}
select '年龄分布' as title, '20岁以下' as name, {_share("young")} as value from n
union all select '年龄分布', '20岁到30岁', round(100 - {_share("young")} - {_share("aged")}, 1) from n
union all select '年龄分布', '30岁及30岁以上', {_share("aged")} from n""",
    "q21b_search_response": f"""with {RED_WIDGET}, {COUNTS}, best as (
  select *, row_number() over (order by {_score("red", "widget")} desc, order_detail_id) as rn from hit),
detail as (
  select to_json(list(json_object('order_detail_id', order_detail_id, 'order_id', order_id,
           'order_status', order_status, 'create_time', create_time, 'user_id', user_id, 'sku_id', sku_id,
           'user_gender', user_gender, 'user_age', user_age, 'user_level', user_level, 'sku_price', sku_price,
           'sku_name', sku_name, 'dt', dt) order by rn)) as rows
  from best where rn <= 10)
select cast(json_object('total', total, 'detail', rows, 'stat', json_array(
         json_object('options', json_array(json_object('name', '男', 'value', {_share("male")}),
           json_object('name', '女', 'value', round(100 - {_share("male")}, 1))), 'title', '性别分布'),
         json_object('options', json_array(json_object('name', '20岁以下', 'value', {_share("young")}),
           json_object('name', '20岁到30岁', 'value', round(100 - {_share("young")} - {_share("aged")}, 1)),
           json_object('name', '30岁及30岁以上', 'value', {_share("aged")})), 'title', '年龄分布'))) as varchar) as response
from n, detail""",
    "q22_kpi_cards": """select 'dau' as id, '新增日活' as name, cast(count(distinct user_id) as double) as value from events
where cast(ts as date) = date '2024-01-15'
union all
select 'new_mid', '新增设备', cast(count(*) as double) from (
  select user_id from events group by user_id having cast(min(ts) as date) = date '2024-01-15')
union all
select 'order_amount', '新增交易额', round(sum(o_totalprice), 2) from orders
where cast(o_orderdate as date) = date '1998-06-01'""",
    "q22b_new_devices": """select strftime(first_ts, '%Y-%m-%d') as log_date, count(*) as new_mid
from (select user_id, min(ts) as first_ts from events group by user_id) group by 1""",
    "q23_cdc_route": """select 'order' as topic, 'order_info' as table_name, 'INSERT' as event_type, count(*) as entries,
       count(*) as row_count from orders
union all select 'order_detail', 'order_detail', 'INSERT', count(*), count(*) from lineitem
union all select 'user_info', 'user_info', 'INSERT', count(*), count(*) from customer
union all select 'user_info', 'user_info', 'UPDATE', count(*), 2 * count(*) from customer""",
    "q24_cdc_flatten": f"with {USERS}, {CHANGE_VALUES} select topic, value, pos from flat",
    "q25_user_latest": USER_LATEST,
    "q26_upsert_docs": f"""with {SALES}
select order_detail_id, case order_status when 'F' then 'DONE' else order_status end as order_status, sku_price from sale""",
    "q27_regional_sales": f"""with {ORDERS}
select province_id, n_name as name, count(*) as order_count, round(sum(total_amount), 2) as value
from o left join nation on cast(n_nationkey as varchar) = province_id group by province_id, n_name""",
    "q28_regional_bands": f"""with {ORDERS}
select n_name as name, count(*) as value, cast(least(count(*) // 100, 5) as int) as band
from o left join nation on cast(n_nationkey as varchar) = province_id group by province_id, n_name""",
    "q29_multi_day_read": """select strftime(ts, '%Y-%m-%d') as log_date, count(distinct user_id) as dau from events
where cast(ts as date) between date '2024-01-10' and date '2024-01-16' group by 1""",
    "q30_stream_dau": f"with {FIRST} select mid, uid, log_date, log_hour from first_login",
    "q31_stream_alert": ALERT_DOCS,
    "q32_stream_sale_detail": f"""with {SALES}
select {SALE_FIELDS} from sale
where detail_ts between order_ts - interval '100 days' and order_ts + interval '100 days'""",
    "q33_stream_orders": DAILY_TURNOVER,
    "q34_stream_users": USER_LATEST,
    "q35_stream_changes": f"with {USERS}, {CHANGE_VALUES} select topic, value from flat",
}

# The dashboard's questions to stored tables have the answers of the same questions to the raw ones.
SQL["q36_served_turnover"] = SQL["q07_gmv_total"]
SQL["q36b_served_turnover_hours"] = SQL["q10_hourly_compare_gmv"]
SQL["q37_served_search"] = f"""with {_hits("widget")}
select count(*) as total from hit
where dt = '1998-06-01' and detail_ts between order_ts - interval '100 days' and order_ts + interval '100 days'"""
SQL["q38_served_devices"] = SQL["q02b_dau_of_day"]
SQL["q38b_served_device_hours"] = SQL["q09_hourly_compare_dau"]
SQL["q39_new_devices_from_table"] = """select count(*) as dau, count(*) filter (where first_day = date '2024-01-15') as new_mid
from (select user_id, cast(min(ts) as date) as first_day, max(cast(ts as date) = date '2024-01-15') as active
      from events group by user_id) where active"""
SQL["q40_kpi_json"] = f"""with card as ({SQL["q22_kpi_cards"]}), placed as (
  select *, list_position(['dau', 'new_mid', 'order_amount'], id) as pos from card)
select cast(to_json(list(json_object('id', id, 'name', name, 'value', value) order by pos)) as varchar) as response from placed"""

SQL["q41_stream_dau_late"] = SQL["q30_stream_dau"]
SQL["q41b_stream_alert_late"] = SQL["q31_stream_alert"]
SQL["q42_stream_unmatched"] = f"""with {ORDERS}, {DETAILS}
select o.id as order_id, cast(null as varchar) as order_detail_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S') as seen_at,
       'order_only' as status
from o where not exists (select 1 from d where d.order_id = o.id
                         and d.detail_ts between o.order_ts - interval '100 days' and o.order_ts + interval '100 days')
union all
select d.order_id, d.id, strftime(detail_ts, '%Y-%m-%d %H:%M:%S'), 'detail_only'
from d where not exists (select 1 from o where d.order_id = o.id
                         and d.detail_ts between o.order_ts - interval '100 days' and o.order_ts + interval '100 days')"""
SQL["q43_cards_from_tables"] = SQL["q22_kpi_cards"]
SQL["q45_backfilled_orders"] = f"""with {ORDERS}
select create_date, round(sum(total_amount + 1), 2) as sum_amount from o group by create_date"""
SQL["q44_indexed_search"] = f"""with {RED_WIDGET}
select order_detail_id, sku_name, dt, round({_score("red", "widget")}, 6) as score
from hit where detail_ts between order_ts - interval '100 days' and order_ts + interval '100 days'
order by {_score("red", "widget")} desc, order_detail_id limit 100"""
SQL["q46_search_walk"] = f"""with {_hits("widget")}
select order_detail_id, sku_name, round({_score("widget")}, 6) as score
from hit order by {_score("widget")} desc, order_detail_id limit 40 offset 80"""
