"""Schemas and column groups of the player-log tables."""

from pyspark.sql.types import (
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

DAY = "create_room_date"

# The fields of one raw message, every one of them a string.
RAW_FIELDS = (
    "createRoomDate",
    "method",
    "ingametime",
    "ip",
    "deathCount",
    "roomID",
    "datetime",
    "x",
    "y",
    "inputkey",
    "account",
    "champion",
    "status",
)

RAW_SCHEMA = StructType([StructField(name, StringType()) for name in RAW_FIELDS])

BRONZE_SCHEMA = StructType(
    [
        StructField(DAY, DateType()),
        StructField("method", StringType()),
        StructField("current_time", IntegerType()),
        StructField("death_count", IntegerType()),
        StructField("room_id", StringType()),
        StructField("datetime", TimestampType()),
        StructField("x", IntegerType()),
        StructField("y", IntegerType()),
        StructField("inputkey", StringType()),
        StructField("champion", StringType()),
        StructField("status", IntegerType()),
        StructField("encrypted_account", StringType()),
    ]
)

# Columns a scored bronze table has on top of BRONZE_SCHEMA.
PREDICTION = "prediction"
FEATURES = "features_vector"
MODEL_COLUMNS = (FEATURES, PREDICTION)

SCORED_SCHEMA = StructType([*BRONZE_SCHEMA.fields, StructField(PREDICTION, IntegerType())])

TRAIN_COLUMNS = (
    "cahmpion_indexed",  # spelled as in the published table
    "datetime",
    "encrypted_account",
    "inputkey_indexed",
    "x",
    "y",
    "label",
    DAY,
)
