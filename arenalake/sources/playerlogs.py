"""Raw player logs derived from the ``events`` test table.

The test data have no game messages; this maps every event to one, planting
NULL and malformed fields for the bronze tests.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.schema import RAW_FIELDS

# Champion names and keys, in the order the indexes refer to.
CHAMPIONS = (
    "AZIR VIKTOR ORIANA VEX RYZE ARI SYNDRA TAILIYAH XERATH MALZAHAR ANIVIA SYLAS "
    "AURELION_SOL RUX VLADIMIR NEEKO ZILEAN"
).split()
KEYS = "q w e r space b d f null alt tab alt+tab esc shift enter".split()


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_playerlogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 string fields of every event's message."""
    return playerlogs_of(read_table(spark, sf_dir, "events"))


def playerlogs_of(events: DataFrame) -> DataFrame:
    names = ", ".join(f"'{c}'" for c in CHAMPIONS)
    keys = ", ".join(f"'{k}'" for k in KEYS)
    base = events.select(
        "*",
        F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z'").alias("iso"),
        F.expr(
            "case when user_id % 17 = 1 and (event_id * 7 + user_id) % 10 < 3 "
            "then 3000 else 400 end"
        ).alias("span"),
    )
    fields = {
        "createRoomDate": "case when event_id % 211 <> 5 then iso end",
        "method": (
            "case event_type when 'purchase' then '/buyItem' when 'view' then '/wait' "
            "else '/move' end"
        ),
        "ingametime": (
            "cast((hour(ts) % 6) * 3600 + minute(ts) * 60 + cast(second(ts) as int) as string)"
        ),
        "ip": "'192.168.' || (user_id % 256) || '.' || (event_id % 256)",
        "deathCount": (
            "case when event_id % 89 = 7 then '-1' when event_id % 101 = 9 then null "
            "else cast((event_id div 50) % 12 as string) end"
        ),
        "roomID": (
            "case when event_id % 127 = 11 then '' when event_id % 137 = 17 then null "
            "else 'room_' || date_format(ts, 'yyyy-MM-dd') || '_' || (user_id % 4) || '_' "
            "|| (hour(ts) div 6) end"
        ),
        "datetime": "case when event_id % 139 = 19 then 'garbage' else iso end",
        "x": (
            "case when event_id % 97 = 3 then 'abc' else "
            "cast((event_id * 7919 + user_id * 31) % (2 * span + 1) - span as string) end"
        ),
        "y": "cast((event_id * 104729 + user_id * 17) % (2 * span + 1) - span as string)",
        "inputkey": (
            f"element_at(array({keys}), cast((event_id * 13 + user_id) % 15 + 1 as int))"
        ),
        "account": "case when event_id % 127 <> 11 then 'testAccount_' || user_id end",
        "champion": (
            "case when event_id % 127 = 11 or event_id % 131 = 13 then '' "
            f"else element_at(array({names}), cast(user_id % 17 + 1 as int)) end"
        ),
        "status": "case when event_type = 'error' then '1' else '0' end",
    }
    return base.select(*[F.expr(fields[name]).alias(name) for name in RAW_FIELDS])


def to_messages(raw: DataFrame) -> DataFrame:
    """Raw rows as JSON text in a ``value`` column; NULL fields are left out."""
    return raw.select(F.to_json(F.struct(*RAW_FIELDS)).alias("value"))
