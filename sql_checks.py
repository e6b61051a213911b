"""DuckDB SQL for every query that SQL can express, over the same Parquet tables."""

from __future__ import annotations

LEGS = """legs as (
  select
    case user_id % 25
      when 0 then concat('400', lpad(cast(user_id as varchar), 8, '0'))
      when 1 then concat('95', lpad(cast(user_id as varchar), 9, '0'))
      when 2 then concat('130', cast(user_id as varchar))
      else concat('130', lpad(cast(user_id as varchar), 8, '0')) end as calling_number,
    case when event_id % 97 = 0 then null
      else concat('130', lpad(cast((event_id * 37 + 11) % 300 as varchar), 8, '0')) end as called_number,
    concat('op', cast(user_id % 3 as varchar)) as calling_operator,
    concat('loc', cast(user_id % 7 as varchar)) as calling_location,
    concat('op', cast(event_id % 3 as varchar)) as called_operator,
    concat('loc', cast(event_id % 7 as varchar)) as called_localion,
    'CN' as calling_countryname,
    concat('prov', cast(user_id % 5 as varchar)) as calling_provincename,
    concat('city', cast(user_id % 11 as varchar)) as calling_cityname,
    cast(1510329600 + event_id * 10 + leg as varchar) as btime,
    case when event_type = 'click' then '120' else '121' end as protocolid,
    case when event_type = 'click' and event_id % 5 = 0 then null
      else cast(event_id % 600 as varchar) end as call_duration,
    case event_id % 11 when 0 then null when 1 then '' when 2 then '12.7'
      else cast(event_id % 300 as varchar) end as answerdur,
    cast(event_id as varchar) as callid,
    case event_id % 4 when 0 then '10.14.1.1' when 1 then '10.140.2.2'
      when 2 then '10.14.9.9' else '10x14.1.1' end as dest_ne_ip,
    case when event_id % 5 = 0 then '1' when event_id % 7 = 0 then null else '0' end as mathch_fraud_pattern,
    case when event_id % 2 = 0 then '0' else '1' end as mathch_white_pattern,
    case when event_id % 3 < 2 then 20171111 else 20171112 end as _add_day
  from events, unnest(case when event_id % 3 = 0 then [0, 1] else [0] end) as l(leg)
)"""

TODAY = """today as (
  select * from legs where _add_day = 20171111 and dest_ne_ip like '10.14%'
)"""

CALLS = """calls as (
  select
    concat('130', lpad(cast(user_id as varchar), 8, '0')) as phone1,
    case when event_id % 97 <> 0
      then concat('130', lpad(cast((event_id * 37 + 11) % 300 as varchar), 8, '0')) end as phone2,
    case when event_id % 2 = 0 then 'call_src' else 'call_dst' end as call_event,
    cast(user_id % 3 as integer) as phone1_type,
    cast(event_id % 10 as integer) as phone2_type,
    cast(event_id % 600 as varchar) as "callDuration",
    cast(event_id % 24 as integer) as hours
  from events
)"""

PREDICTED = """predicted as (
  select vec_id, cast(list_position(head, list_max(head)) - 1 as double) as label,
    cast(list_position(coarse, list_max(coarse)) - 1 as double) as prediction
  from (
    select vec_id, embedding[1:4] as head,
      list_transform(embedding[1:4], lambda x: floor(cast(x as double) * 10)) as coarse
    from embeddings
  )
)"""

SESSION_KEYS = """calling_number, called_number, callid, calling_operator, calling_location, calling_countryname,
  calling_provincename, calling_cityname, called_operator, called_localion"""

SPLIT_POINT = "(((vec_id % 2147483648) * 2654435761) % 4294967296) / 4294967296.0"


def bigint(x: str) -> str:
    return rf"""case when regexp_matches({x}, '^\s*[+-]?\.[0-9]*\s*$') then cast(0 as bigint)
      when regexp_matches({x}, '^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$')
      then try_cast(regexp_replace(trim({x}), '\.[0-9]*\s*$', '') as bigint) end"""


SECONDS = bigint("coalesce(case protocolid when '120' then call_duration else answerdur end, '0')")


def rollup(source: str) -> str:
    return f"""sessions as (
  select {SESSION_KEYS}, max({bigint("btime")}) as btime, cast(sum({SECONDS}) as bigint) as duration, count(*) as cnt
  from {source} group by {SESSION_KEYS}
)"""


HEAVY = """heavy as (
  select calling_number, count(*) as calls from (
    select calling_number, called_number, callid from today
    where (mathch_fraud_pattern = '0' or mathch_white_pattern = '0')
      and calling_number not like '400%' and calling_number not like '95%'
    group by calling_number, called_number, callid
  ) group by calling_number having count(*) >= 30 and length(calling_number) > 10
)"""

SUSPECT_TRAFFIC = f"""with {LEGS}, {TODAY}, {rollup("today")}, {HEAVY}
select a.calling_number, a.called_number, a.calling_operator, a.calling_location, a.called_operator,
  a.called_localion, a.calling_countryname, a.calling_provincename, a.calling_cityname, a.btime,
  a.duration, a.callid, a.cnt
from sessions a join heavy b on a.calling_number = b.calling_number or a.called_number = b.calling_number"""

GAPPY = """gappy as (
  select vec_id, label, case when vec_id % 7 <> 0 then prediction end as prediction
  from predicted where vec_id % 11 <> 0
)"""

PER_CLASS = """classes as (
  select label as class from gappy union select prediction from gappy where prediction is not null
), per_class as (
  select class, (select count(*) from gappy where label = class) as support,
    (select count(*) from gappy where label = class and prediction = class)
      / nullif((select count(*) from gappy where prediction = class), 0)::double as "precision",
    (select count(*) from gappy where label = class and prediction = class)
      / nullif((select count(*) from gappy where label = class), 0)::double as recall
  from classes
)"""

# The mean gradient of a network without hidden layers at zero weights: 64 rows of 4, then 4 biases.
GRADIENT = """labelled as (
  select list_append(list_transform(embedding, lambda x: cast(x as double) * 10), 1.0) as x,
    list_position(embedding[1:4], list_max(embedding[1:4])) - 1 as label
  from embeddings
), gradients as (
  select cast(i * 4 + j as integer) as pos,
    avg(x[i + 1] * (0.25 - case when j = label then 1 else 0 end)) as gradient
  from labelled, range(0, 65) as a(i), range(0, 4) as b(j) group by i, j
)"""

# One plain step of a network of 64, 3 and 4 units, ReLU between, from fixed weights: 64 rows of 3, 3 biases, 3 rows of 4, 4 biases.
HIDDEN_STEP = """start as (
  select list(((i * 7) % 11 - 5) / 20.0::double order by i) as w from range(0, 211) r(i)
), labelled as (
  select list_append(list_transform(embedding, lambda x: cast(x as double) * 10), 1.0) as x,
    list_position(embedding[1:4], list_max(embedding[1:4])) - 1 as label
  from embeddings
), hidden as (
  select x, label, w, list_transform([0, 1, 2], lambda j: greatest(0.0, list_sum(list_transform(range(0, 65),
    lambda i: x[i + 1] * w[i * 3 + j + 1])))) as h
  from labelled, start
), exponents as (
  select x, label, w, h, list_transform([0, 1, 2, 3], lambda c: exp(w[208 + c] + list_sum(list_transform([0, 1, 2],
    lambda j: h[j + 1] * w[196 + j * 4 + c])))) as e
  from hidden
), deltas as (
  select x, w, h, list_transform([0, 1, 2, 3],
    lambda c: e[c + 1] / list_sum(e) - case when c = label then 1 else 0 end) as d
  from exponents
), gradients as (
  select i * 3 + j as pos, avg(x[i + 1] * case when h[j + 1] > 0 then list_sum(list_transform([0, 1, 2, 3],
    lambda c: d[c + 1] * w[196 + j * 4 + c])) else 0 end) as g
  from deltas, range(0, 65) a(i), range(0, 3) b(j) group by i, j
  union all
  select 195 + j * 4 + c, avg(case when j = 3 then 1 else h[j + 1] end * d[c + 1])
  from deltas, range(0, 4) a(j), range(0, 4) b(c) group by j, c
), stepped as (
  select cast(pos as integer) as pos, round(w[pos + 1] - g, 3) + 0.0::double as value from gradients, start
)"""

SCORED = """select phone1, count(*) as calls, cast(sum(cast("callDuration" as bigint)) as bigint) as seconds,
  max(cast("callDuration" as bigint)) as longest, count(*) filter (hours >= 20) as night_calls
from calls group by phone1"""


def history(fields: str, size: int = 100_000) -> str:
    order = ", ".join(f"{f} nulls first" for f in fields.split(", "))
    return f"""with {CALLS}
select phone1, cast(place // {size} as integer) as part, cast(place % {size} as integer) as pos, {fields}
from (select *, row_number() over (partition by phone1 order by {order}) - 1 as place from calls)"""


def positions(array: str, columns: str = "vec_id", width: int = 64) -> str:
    return f"""select {columns}, cast(i - 1 as integer) as pos, cast(values_[i] as double) as value
from (select *, {array} as values_ from embeddings), range(1, {width + 1}) as r(i)"""


def checks() -> dict[str, str]:
    return {
        "cdr_scan": f"with {LEGS}, {TODAY} select * from today",
        "cdr_caller_filter": f"""with {LEGS} select calling_number, called_number, callid, btime from legs
where calling_number not like '400%' and calling_number not like '95%'""",
        "cdr_pattern_filter": f"""with {LEGS}
select callid, btime, mathch_fraud_pattern, mathch_white_pattern from legs
where mathch_fraud_pattern = '0' or mathch_white_pattern = '0'""",
        "cdr_distinct_calls": f"""with {LEGS} select calling_number, called_number, callid from legs
group by calling_number, called_number, callid""",
        "cdr_session_rollup": f"with {LEGS}, {TODAY}, {rollup('today')} select * from sessions",
        "cdr_heavy_callers": f"with {LEGS}, {TODAY}, {HEAVY} select * from heavy",
        "either_endpoint_join": f"""with {LEGS}, {TODAY}, {rollup("legs")}, {HEAVY}
select a.calling_number, a.called_number, a.callid, a.cnt, b.calls
from sessions a join heavy b on a.calling_number = b.calling_number or a.called_number = b.calling_number""",
        "cdr_suspect_traffic": SUSPECT_TRAFFIC,
        "cdr_suspect_traffic_measured": SUSPECT_TRAFFIC,
        "cdr_suspect_traffic_shuffled": SUSPECT_TRAFFIC,
        "cdr_suspect_traffic_sql": SUSPECT_TRAFFIC,
        "cdr_suspect_traffic_filtered": SUSPECT_TRAFFIC,
        "cdr_heavy_callers_sketched": f"with {LEGS}, {TODAY}, {HEAVY} select * from heavy",
        "cdr_table_scan": f"with {LEGS}, {TODAY} select * from today",
        "cdr_table_distinct_calls": f"""with {LEGS} select calling_number, called_number, callid from legs
group by calling_number, called_number, callid""",
        "cdr_table_session_rollup": f"with {LEGS}, {TODAY}, {rollup('today')} select * from sessions",
        "cdr_table_heavy_callers": f"with {LEGS}, {TODAY}, {HEAVY} select * from heavy",
        "cdr_table_suspect_traffic": SUSPECT_TRAFFIC,
        "cdr_day_sessions": f"""with {LEGS}, watched as (select * from legs where dest_ne_ip like '10.14%'),
{rollup("watched")} select * from sessions""",
        "cdr_day_suspect_traffic": SUSPECT_TRAFFIC,
        "safe_bigint": f"""select event_id, txt, {bigint("txt")} as number from (
  select event_id, case event_id % 13
    when 0 then n when 1 then ' ' || n || ' ' when 2 then n || '.7' when 3 then '-' || n || '.7'
    when 4 then '.' || n when 5 then '.' when 6 then n || '.9999999' when 7 then n || 'e3'
    when 8 then '9223372036854775808' || n when 9 then 'abc' || n when 10 then '' when 12 then '+' || n end as txt
  from (select event_id, cast(event_id as varchar) as n from events)
)""",
        "duration_expr": f"with {LEGS} select callid, btime, protocolid, {SECONDS} as seconds from legs",
        "regex_replace_all": r"""select page_id, regexp_replace(regexp_replace(regexp_replace(
  html, 'List', '', 'g'), '\(', '[', 'g'), '\)', ']', 'g') as cleaned from pages""",
        "calls_typed": f"with {CALLS} select * from calls",
        "calls_literal": """select event_id, l.* from events join (values
  ('100', '204', 'call_dst', 1, 2, '17', 3), ('101', '0991', 'call_src', 2, 2, '3', 22)
) l(phone1, phone2, call_event, phone1_type, phone2_type, "callDuration", hours) on event_id % 24 = hours""",
        "call_history_by_phone": history('phone2, call_event, phone1_type, phone2_type, "callDuration", hours'),
        "call_history_by_phone_6": history('phone2, phone1_type, phone2_type, "callDuration", hours'),
        "call_history_in_parts": history(
            'phone2, call_event, phone1_type, phone2_type, "callDuration", hours', 25
        ),
        "call_history_variant": "select phone1, part, pos, phone2, \"callDuration\" from ("
        + history('phone2, call_event, phone1_type, phone2_type, "callDuration", hours')
        + ")",
        "call_history_json": f"""with {CALLS}
select phone1, cast(0 as integer) as part, cast(to_json(list(c order by phone2 nulls first, call_event,
  phone1_type, phone2_type, "callDuration", hours)) as varchar) as calls
from calls c group by phone1""",
        "py_scalar_sql": "select event_id, event_id + user_id as total from events",
        "py_scalar_add": "select event_id, event_id + user_id as total from events",
        "py_module_udf": f"""with {CALLS}
select phone1, phone2, hours, cast(hours + phone2_type as bigint) as total from calls""",
        "py_grouped_score": f"with {CALLS} {SCORED}",
        "py_grouped_score_in_parts": f"with {CALLS} {SCORED}",
        "py_grouped_score_large_keys": """select big_id, count(*) as n, max(event_id) as last_event
from (select case when user_id % 10 <> 0 then user_id + 9007199254740992 end as big_id, event_id from events)
group by big_id""",
        "py_grouped_stream": f"""with {LEGS}, gaps as (
  select calling_number, start, start - lag(start) over (partition by calling_number order by start) as gap
  from (select calling_number, cast(btime as bigint) as start from legs)
)
select calling_number, count(*) as legs, max(gap) as longest_gap, arg_max(start - gap, (gap, -start)) as since
from gaps group by calling_number""",
        "take_n": f"with {CALLS} {SCORED} order by phone1 limit 5",
        "py_ndarray_reshape": """select vec_id, cast(j * 32 + i as integer) as pos,
  cast(embedding[i * 2 + j + 1] as double) as value
from embeddings, range(0, 32) as a(i), range(0, 2) as b(j)""",
        "array_reshape": """select vec_id, cast(i as integer) as pos,
  cast(embedding[i * 2 + 1] as double) as x0, cast(embedding[i * 2 + 2] as double) as x1
from embeddings, range(0, 32) as r(i)""",
        "ml_load": positions("embedding", "vec_id, label"),
        "ml_labelled": positions(
            "embedding", "vec_id, case when vec_id % 11 <> 0 then cast(label as double) end as label"
        ),
        "ml_scale": positions("list_transform(embedding, lambda x: cast(cast(x as double) / 255 as float))"),
        "ml_flatten": positions("list_concat(embedding[33:64], embedding[1:32])"),
        "ml_one_hot": """select vec_id, cast(i as integer) as pos,
  case when i = label then cast(1 as double) else cast(0 as double) end as value
from embeddings, range(0, 10) as r(i) where vec_id % 11 <> 0""",
        "ml_train_test": f"""select vec_id, case when {SPLIT_POINT} < 0.1 then 'test' else 'train' end as part
from embeddings""",
        "ml_validation_split": f"""select vec_id,
  case when {SPLIT_POINT} >= 0.1 and {SPLIT_POINT} < 0.2 then 'validation' else 'fit' end as part
from embeddings""",
        "ml_exact_split": f"""select vec_id, label, case when place <= floor(n * 0.1::double + 0.5) then 'test' else 'train' end as part
from (
  select vec_id, label, row_number() over (partition by label order by {SPLIT_POINT}, vec_id) as place,
    count(*) over (partition by label) as n
  from embeddings
)""",
        "ml_row_counts": f"""select part, count(*) as n from (
  select case when {SPLIT_POINT} < 0.1 then 'test' else 'train' end as part from embeddings
) group by part""",
        "ml_confusion": f"""with {PREDICTED}
select label, prediction, count(*) as n from predicted group by label, prediction""",
        "ml_precision_micro": f"""with {PREDICTED}, {GAPPY}
select avg(case when label = prediction then 1.0::double else 0.0::double end) as "precision" from gappy""",
        "ml_recall_micro": f"""with {PREDICTED}, {GAPPY}
select avg(case when label = prediction then 1.0::double else 0.0::double end) as recall from gappy""",
        "ml_per_class": f"with {PREDICTED}, {GAPPY}, {PER_CLASS} select * from per_class",
        "ml_weighted": f"""with {PREDICTED}, {GAPPY}, {PER_CLASS}
select round(sum(coalesce("precision", 0) * support) / sum(support), 9) as "precision",
  round(sum(coalesce(recall, 0) * support) / sum(support), 9) as recall
from per_class""",
        "ml_mlp_builtin": f"select count(*) as n, true as reached from embeddings where {SPLIT_POINT} < 0.1",
        "ml_mlp_data_parallel": f"select count(*) as n, true as reached from embeddings where {SPLIT_POINT} < 0.1",
        "ml_end_to_end": f"select count(*) as n, true as reached from embeddings where {SPLIT_POINT} < 0.1",
        "ml_mlp_distributed": f"with {HIDDEN_STEP} select * from stepped",
        "ml_mlp_synchronous": f"with {HIDDEN_STEP} select * from stepped",
        "ml_mlp_synchronous_rounds": f"select count(*) as n, true as reached from embeddings where {SPLIT_POINT} < 0.1",
        "ml_mlp_linear": f"with {GRADIENT} select pos, round(-gradient, 2) + 0.0::double as value from gradients",
        "ml_mlp_adadelta": f"""with {GRADIENT}
select pos, round(-gradient * sqrt(0.01) / sqrt(0.1 * gradient * gradient + 0.01), 2) + 0.0::double as value
from gradients""",
        "ml_predict": """select vec_id, cast(label - 1 as double) as prediction,
  round(e[label] / list_sum(e), 3) as probability
from (
  select vec_id, list_position(embedding[1:4], list_max(embedding[1:4])) as label,
    list_transform(embedding[1:4], lambda x: exp(cast(x as double) * 10)) as e
  from embeddings
)""",
        "ml_log_loss": """select round(avg(-ln(e[cast(label as integer)] / list_sum(e))), 9) as log_loss from (
  select list_position(embedding[1:4], list_max(embedding[1:4])) as label,
    list_transform(embedding[1:4], lambda x: exp(cast(x as double) * 10)) as e
  from embeddings
)""",
        "show_predictions": f"with {PREDICTED} select * from predicted order by vec_id limit 100",
    }
