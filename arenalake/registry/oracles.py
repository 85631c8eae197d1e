"""The registered queries as SQL over the same tables, for an independent check."""

from arenalake.sources.playerlogs import CHAMPIONS, KEYS


def _text_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


FIRST_DAY = "(select cast(min(ts) as date) from events)"
ONE_DAY = f"({FIRST_DAY} + 4)"
IN_MONTH = f"strftime(create_room_date, '%Y-%m') = strftime({ONE_DAY}, '%Y-%m')"

BASE = """base as (
  select *, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' as iso,
         case when user_id % 17 = 1 and (event_id * 7 + user_id) % 10 < 3
              then 3000 else 400 end as span
  from events
)"""

RAW = f"""{BASE}, raw as (
  select case when event_id % 211 <> 5 then iso end as "createRoomDate",
         case event_type when 'purchase' then '/buyItem' when 'view' then '/wait'
              else '/move' end as "method",
         cast((hour(ts) % 6) * 3600 + minute(ts) * 60 + second(ts) as varchar) as ingametime,
         '192.168.' || (user_id % 256) || '.' || (event_id % 256) as ip,
         case when event_id % 89 = 7 then '-1' when event_id % 101 = 9 then null
              else cast((event_id // 50) % 12 as varchar) end as "deathCount",
         case when event_id % 127 = 11 then '' when event_id % 137 = 17 then null
              else 'room_' || strftime(ts, '%Y-%m-%d') || '_' || (user_id % 4) || '_'
                   || (hour(ts) // 6) end as "roomID",
         case when event_id % 139 = 19 then 'garbage' else iso end as "datetime",
         case when event_id % 97 = 3 then 'abc' else
              cast((event_id * 7919 + user_id * 31) % (2 * span + 1) - span as varchar)
              end as x,
         cast((event_id * 104729 + user_id * 17) % (2 * span + 1) - span as varchar) as y,
         {_text_list(KEYS)}[(event_id * 13 + user_id) % 15 + 1] as inputkey,
         case when event_id % 127 <> 11 then 'testAccount_' || user_id end as account,
         case when event_id % 127 = 11 or event_id % 131 = 13 then ''
              else {_text_list(CHAMPIONS)}[user_id % 17 + 1] end as champion,
         case when event_type = 'error' then '1' else '0' end as status
  from base
)"""

OK = """coalesce("createRoomDate" is not null
  and try_cast(ingametime as integer) is not null
  and try_cast(x as integer) is not null
  and try_cast(y as integer) is not null
  and try_cast("deathCount" as integer) >= 0
  and try_cast(status as integer) >= 0, false)"""

TYPED = """try_cast("createRoomDate" as date) as create_room_date, "method",
  try_cast(ingametime as integer) as "current_time",
  try_cast("deathCount" as integer) as death_count, "roomID" as room_id,
  try_cast("datetime" as timestamp) as "datetime",
  try_cast(x as integer) as x, try_cast(y as integer) as y,
  inputkey, champion, try_cast(status as integer) as status"""

BRONZE = f"""{RAW}, bronze as (
  select {TYPED}, sha256(account) as encrypted_account from raw where {OK}
)"""

KEEP_ANY = """coalesce(champion, '') <> '' or coalesce(encrypted_account, '') <> ''
  or coalesce(room_id, '') <> ''"""

KEEP_ALL = """champion <> '' and encrypted_account <> '' and room_id <> ''
  and "current_time" is not null and "datetime" is not null"""

SILVER_SELECT = f"""select *, x + y as "x+y",
  case when "method" = '/buyItem' then 1 else 0 end as buy
  from bronze where {KEEP_ANY}"""

SILVER = f"{BRONZE}, silver as ({SILVER_SELECT})"


def _moved(group):
    order = [
        "room_id", '"current_time"', '"datetime"', "x", "y", '"method"', "death_count",
        "inputkey", "champion", "status",
    ]
    keys = ", ".join(f"{c} nulls first" for c in order)
    window = f"(partition by {group} order by {keys})"
    return (
        f"select *, lag(x) over {window} as prev_x, lag(y) over {window} as prev_y from bronze"
    )


MOVED = f"{BRONZE}, moved as ({_moved('encrypted_account, create_room_date')})"
DISTANCE = "round(sqrt(pow(x - prev_x, 2) + pow(y - prev_y, 2)))"
FILLED = f"""* replace (coalesce(prev_x, 0) as prev_x, coalesce(prev_y, 0) as prev_y),
  coalesce({DISTANCE}, 0) as distance"""


def _ranks(column, by=""):
    keys = f"{by}, {column}" if by else column
    part = f"partition by {by} " if by else ""
    return f"""(select {keys}, cast(row_number() over ({part}order by count(*) desc, {column}) - 1
      as double) as rank from bronze group by {keys})"""


TRAIN = f"""{BRONZE}, train as (
  select b.*, c.rank as cahmpion_indexed, k.rank as inputkey_indexed,
         case when b.champion = 'VIKTOR' then 1 else 0 end as label
  from bronze b
  join {_ranks("champion", "create_room_date")} c
    on b.champion = c.champion and b.create_room_date is not distinct from c.create_room_date
  join {_ranks("inputkey", "create_room_date")} k
    on b.inputkey = k.inputkey and b.create_room_date is not distinct from k.create_room_date
)"""


def _gold(keys, measures):
    return f"select {keys}, {measures} from silver group by {keys}"


SHARE = """round(cast(cast(count(*) filter (where inputkey = 'alt') as double) / count(*)
  as decimal(18, 12)), 2)::double"""

GOLD = {
    "average_death_and_time": _gold(
        "encrypted_account, champion, create_room_date",
        """round(avg(death_count), 6) as average_deaths,
           round(avg("current_time"), 6) as average_game_time""",
    ),
    "champion_death_count": _gold(
        "room_id, champion, create_room_date", "max(death_count) as death_count"
    ),
    "key_used_per": _gold(
        "champion, create_room_date",
        f"""count(*) filter (where inputkey = 'alt') as used, count(*) as total,
            {SHARE} as total_q""",
    ),
    "room_end_time": _gold("room_id, create_room_date", 'max("current_time") as end_time'),
    "room_champion_xy": _gold(
        "room_id, encrypted_account, champion, create_room_date",
        "round(stddev_samp(x), 6) as stddev_x, round(stddev_samp(y), 6) as stddev_y",
    ),
}

BRONZE_ROWS = f"with {BRONZE} select * from bronze"
RAW_ROWS = f"with {RAW} select * from raw"
INVALID_ROWS = f"with {RAW} select * from raw where not {OK}"
QUARANTINE_ROWS = f"""with {RAW} select *, try_cast("createRoomDate" as date) as create_room_date
  from raw where not {OK}"""
AGREEMENT = f"""with {BRONZE} select count(*) as "rows", cast(0 as bigint) as differing
  from bronze"""
INDEXED = f"""with {BRONZE} select b.champion, c.rank as champion_indexed,
    b.inputkey, k.rank as inputkey_indexed from bronze b
    join {_ranks("champion")} c on b.champion = c.champion
    join {_ranks("inputkey")} k on b.inputkey = k.inputkey"""
PREVIOUS = f"with {MOVED} select * from moved"
ARCHIVED = f"""with {BRONZE} select * from bronze
  where {IN_MONTH}"""


SEPARATED = """separated as (
  select event_id, cast(event_id % 5 + (event_id % 2) * 1000 as integer) as x,
         cast(event_id % 7 - (event_id % 2) * 500 as integer) as y,
         cast(event_id % 2 as integer) as cluster
  from events
)"""

# Mean over all points of (b - a) / max(a, b), from the sums of each group: the mean square
# distance of a point p to the n points of a group is |p|^2 + (sum of squares - 2 p * sum) / n.
SILHOUETTE = f"""{SEPARATED}, sums as (
  select cluster, cast(count(*) as double) as n, sum(cast(x as double)) as sx,
         sum(cast(y as double)) as sy, sum(cast(x as double) * x + cast(y as double) * y) as sq
  from separated group by cluster
), distances as (
  select p.x * p.x + p.y * p.y + (own.sq - 2 * (p.x * own.sx + p.y * own.sy)) / own.n as a, own.n,
         p.x * p.x + p.y * p.y + (o.sq - 2 * (p.x * o.sx + p.y * o.sy)) / o.n as b
  from separated p join sums own on own.cluster = p.cluster join sums o on o.cluster <> p.cluster
), scores as (
  select a * n / (n - 1) as a, b from distances
), score as (
  select round(avg((b - a) / greatest(a, b)), 6) as silhouette from scores
)"""


def _sums(table, source, numbers, others, where="true"):
    """Rows, sums and filled places of a table, in long form."""
    values = ["('rows', cast(count(*) as double))"]
    values += [f"""('{c}', coalesce(cast(sum("{c}") as double), 0))""" for c in numbers]
    values += [f"""('{c}', cast(count("{c}") as double))""" for c in others]
    grouped = f"""select create_room_date, unnest([{", ".join(values)}]) as v from {source}
        where {where} group by create_room_date"""
    return f"""select '{table}' as table_name, create_room_date, v[1] as measure,
        round(v[2], 2) as value from ({grouped})"""


BRONZE_NUMBERS = ["current_time", "death_count", "x", "y", "status"]
BRONZE_OTHERS = ["method", "room_id", "datetime", "inputkey", "champion", "encrypted_account"]
RAW_OTHERS = [
    "createRoomDate", "method", "ingametime", "deathCount", "roomID", "datetime", "x", "y",
    "inputkey", "champion", "status", "encrypted_account",
]
# Table, its source below, numbers and other columns.
DAILY = [
    ("analysis_playerlogs", "silver", [*BRONZE_NUMBERS, "x+y", "buy"], BRONZE_OTHERS),
    (
        "train_playerlogs", "trained", ["cahmpion_indexed", "inputkey_indexed", "x", "y", "label"],
        ["datetime", "encrypted_account", "event_date"],
    ),
    ("delta_playerlogs", "filled", [*BRONZE_NUMBERS, "prev_x", "prev_y", "distance"], BRONZE_OTHERS),
    (
        "average_death_and_time", "average_death_and_time", ["average_deaths", "average_game_time"],
        ["encrypted_account", "champion"],
    ),
    ("champion_death_count", "champion_death_count", ["death_count"], ["room_id", "champion"]),
    ("key_used_per", "key_used_per", ["used", "total", "total_q"], ["champion"]),
    ("room_end_time", "room_end_time", ["end_time"], ["room_id"]),
    (
        "room_champion_xy", "room_champion_xy", ["stddev_x", "stddev_y"],
        ["room_id", "encrypted_account", "champion"],
    ),
]


def _daily(run, where):
    parts = [f"select *, '{run}' as run from ({_sums(*table, where)})" for table in DAILY]
    return " union all ".join(parts)


FANOUT = f"""with {BRONZE}, refused as (
    select *, try_cast("createRoomDate" as date) as create_room_date,
           sha256(account) as encrypted_account from raw where not {OK})
    {_sums("playerlogs", "bronze", BRONZE_NUMBERS, BRONZE_OTHERS)}
    union all {_sums("invalid_data", "refused", [], RAW_OTHERS)}"""

ORACLES = {
    "src_kafka_stream": RAW_ROWS,
    "src_json_month_glob": ARCHIVED,
    "src_table_day": f"{BRONZE_ROWS} where create_room_date = {ONE_DAY}",
    "src_table_day_sql": f"""with {SILVER} select * from silver
        where create_room_date = {ONE_DAY}""",
    "src_table_full": f"with {MOVED} select {FILLED} from moved",
    "src_model_load": AGREEMENT,
    "sink_stream_parquet_table": BRONZE_ROWS,
    "sink_stream_quarantine_table": QUARANTINE_ROWS,
    "sink_stream_json_path": BRONZE_ROWS,
    "sink_stream_quarantine_json": INVALID_ROWS,
    "sink_dynamic_partition_overwrite": f"""with {BRONZE} select * replace (
        cast(case when create_room_date = {ONE_DAY} then x + 1000
                  when create_room_date = {FIRST_DAY} then x + 2000 else x end as integer) as x)
        from bronze""",
    "sink_full_overwrite": f"{BRONZE_ROWS} where champion = 'VIKTOR'",
    "sink_month_archive": ARCHIVED,
    "sink_month_archive_json": ARCHIVED,
    "sink_model_save": AGREEMENT,
    "parse_value_string": f'with {RAW} select "datetime", x, ip from raw',
    "parse_json_fixed": RAW_ROWS,
    "expand_struct": RAW_ROWS,
    "typed_rename": f"with {RAW} select {TYPED}, account, ip from raw where {OK}",
    "cast_int": f"""with {RAW} select "datetime", ip,
        try_cast(ingametime as integer) as ingametime,
        try_cast("deathCount" as integer) as "deathCount", try_cast(x as integer) as x,
        try_cast(y as integer) as y, try_cast(status as integer) as status from raw""",
    "cast_date": f"""with {RAW} select ip, ingametime,
        try_cast("createRoomDate" as date) as create_room_date from raw""",
    "cast_timestamp": f"""with {RAW} select ip, x,
        try_cast("datetime" as timestamp) as "datetime" from raw""",
    "pseudonymise_account": f"""with {RAW} select "roomID", ingametime,
        sha256(account) as encrypted_account from raw""",
    "drop_columns": BRONZE_ROWS,
    "derive_x_plus_y": f'with {BRONZE} select x, y, x + y as "x+y" from bronze',
    "flag_buy": f"""with {BRONZE} select room_id, "method", x,
        case when "method" = '/buyItem' then 1 else 0 end as buy from bronze""",
    "label_champion": f"""with {BRONZE} select champion, x, y,
        case when champion = 'VIKTOR' then 1 else 0 end as label from bronze""",
    "date_from_timestamp": f"""with {BRONZE} select x, "current_time",
        cast("datetime" as date) as create_room_date from bronze""",
    "parse_date_fmt": f"""with {RAW} select x,
        try_cast(substring("createRoomDate", 1, 10) as date) as from_text,
        try_cast("createRoomDate" as date) as from_date from raw""",
    "subset_columns": f"""with {TRAIN} select cahmpion_indexed, "datetime", encrypted_account,
        inputkey_indexed, x, y, label, create_room_date from train""",
    "fill_nulls": f"""with {MOVED}, filled as (select {FILLED} from moved)
        select encrypted_account, create_room_date, prev_x, prev_y, distance from filled""",
    "euclid_step": f"with {MOVED} select x, y, prev_x, prev_y, {DISTANCE} as distance from moved",
    "ratio_round2": f"""with {SILVER} select room_id, champion, {SHARE} as total_q
        from silver group by room_id, champion""",
    "month_of_date": f"""with {BRONZE} select strftime(create_room_date, '%Y-%m') as "month",
        champion, count(*) as "rows" from bronze group by 1, 2""",
    "valid_rows": f"with {RAW} select * from raw where {OK}",
    "invalid_rows": INVALID_ROWS,
    "filter_day": f"""with {BRONZE} select create_room_date, champion, count(*) as "rows"
        from bronze where create_room_date between {FIRST_DAY} + 9 and {FIRST_DAY} + 19
        group by 1, 2""",
    "silver_keep_any": f"{BRONZE_ROWS} where {KEEP_ANY}",
    "silver_keep_all": f"{BRONZE_ROWS} where {KEEP_ALL}",
    **{f"gold_{name}": f"with {SILVER} {sql}" for name, sql in GOLD.items()},
    "prev_position": PREVIOUS,
    "prev_position_per_room": f"""with {BRONZE}, moved as
        ({_moved('encrypted_account, create_room_date, room_id')}) select * from moved""",
    "prev_position_sliced": PREVIOUS,
    "movement_features": f"with {MOVED} select {FILLED} from moved",
    "sort_room_time": f"with {SILVER} select * from silver",
    "sort_room": f"""with {SILVER} select count(*) as "rows", cast(0 as bigint) as violations
        from ({GOLD['champion_death_count']})""",
    "sort_room_time_order": f"""with {SILVER} select count(*) as "rows",
        cast(0 as bigint) as violations from silver""",
    "ml_string_index": INDEXED,
    "ml_string_index_shuffled": INDEXED,
    "train_table_indexed": f"""with {TRAIN} select cahmpion_indexed, "datetime",
        encrypted_account, inputkey_indexed, x, y, label,
        cast("datetime" as date) as create_room_date from train""",
    "ml_assemble": f"""with {BRONZE} select room_id, cast(x as double) as v0,
        cast(y as double) as v1 from bronze""",
    "ml_predict_nearest": f"""with {BRONZE} select count(*) as "rows",
        cast(0 as bigint) as away from bronze""",
    "ml_score_stream": AGREEMENT,
    "stream_checkpoint": BRONZE_ROWS,
    **dict.fromkeys(("stream_fanout", "stream_fanout_once", "stream_recovery"), FANOUT),
    "job_bronze_ingest": BRONZE_ROWS,
    "job_silver_analysis": f"with {SILVER} select * from silver",
    "job_silver_train_indexed": f"""with {TRAIN} select cahmpion_indexed, "datetime",
        encrypted_account, inputkey_indexed, x, y, label,
        cast("datetime" as date) as event_date, create_room_date from train""",
    "job_silver_train_movement": f"with {MOVED} select {FILLED} from moved",
    "job_gold_day": f"with {SILVER} "
    + " union all by name ".join(
        f"select '{name}' as table_name, * from ({sql})" for name, sql in GOLD.items()
    ),
    "job_month_archive": ARCHIVED,
    "job_run_day": f"""with {TRAIN}, silver as ({SILVER_SELECT}),
        moved as ({_moved('encrypted_account, create_room_date')}),
        filled as (select {FILLED} from moved),
        trained as (select *, cast("datetime" as date) as event_date from train), """
    + ", ".join(f"{name} as ({sql})" for name, sql in GOLD.items())
    + f" {_daily('range', 'true')} union all {_daily('day', f'create_room_date = {ONE_DAY}')}",
    "ml_kmeans_fit": f"""with {SEPARATED} select cluster, count(*) as "rows",
        round(avg(x), 6) as centre_x, round(avg(y), 6) as centre_y from separated group by cluster""",
    "ml_predict_batch": f"with {SEPARATED} select event_id, x, y, cluster from separated",
    "ml_silhouette": f"with {SILHOUETTE} select silhouette from score",
    "job_refit": f"""with {SILHOUETTE} select cluster, count(*) as "rows",
        (select silhouette from score) as silhouette from separated group by cluster""",
    "src_kafka_stream_bounded": RAW_ROWS,
    "ml_score_stream_refit": f"with {BRONZE} select count(*) as rows, 2 as versions, 0 as differing from bronze",
    "message_rate_stream": f"""with placed as (
        select ts, date_trunc('minute', ts) as w,
               least((cast(ts as date) - {FIRST_DAY}) // 8 + case when event_id % 20 = 7 then 2 else 0 end, 3) as part
        from events),
      marks as (select p.part, (select date_trunc('millisecond', max(ts)) from placed q where q.part <= p.part)
                 - interval 10 minutes as mark from (select distinct part from placed) p)
      select w as window_start, count(*) as messages from placed
      where not exists (select 1 from marks m where m.part < placed.part and w + interval 1 minute <= m.mark)
        and w + interval 1 minute <= (select max(mark) from marks)
      group by 1""",
    "message_rate": """select date_trunc('minute', ts) as window_start, count(*) as messages
        from events group by 1""",
    "message_rate_per_second": """select date_trunc('second', ts) as window_start,
        count(*) as messages from events group by 1""",
}
