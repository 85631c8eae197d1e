"""Messages to typed, pseudonymised rows. Map-only: no operator here shuffles."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.functions.casts import to_day, to_instant, to_int
from arenalake.functions.features import pseudonym
from arenalake.schema import DAY, FEATURES, RAW_FIELDS, RAW_SCHEMA

MESSAGE_TEXT = "_raw"


def message_text(messages: DataFrame) -> DataFrame:
    """Binary or text ``value`` column to text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def parse_messages(messages: DataFrame, keep_text: bool = False) -> DataFrame:
    """JSON ``value`` column to the raw fields; a broken message gives NULL fields.

    ``keep_text`` keeps the message itself in ``_raw``.

    The struct is expanded with ``inline``: expanding it with ``select("m.*")``
    lets the optimizer push later filters below the expansion, which parses the
    text again for every field a filter mentions.
    """
    parsed = F.inline(F.array(F.from_json("value", RAW_SCHEMA)))
    kept = [F.col("value").alias(MESSAGE_TEXT)] if keep_text else []
    return message_text(messages).select(*kept, parsed)


def is_valid(legacy_int: bool = False, strict_day: bool = False) -> Column:
    """The acceptance test of a raw row. Never NULL, so ``~is_valid()`` is its complement.

    ``strict_day`` also refuses a room date that is present but malformed.
    """
    day = F.col("createRoomDate")
    present = [(to_day("createRoomDate") if strict_day else day).isNotNull()]
    present += [to_int(c, legacy_int).isNotNull() for c in ("ingametime", "x", "y")]
    present += [to_int(c, legacy_int) >= 0 for c in ("deathCount", "status")]
    return F.coalesce(reduce(and_, present), F.lit(False))


def valid_rows(raw: DataFrame, legacy_int: bool = False, strict_day: bool = False) -> DataFrame:
    return raw.filter(is_valid(legacy_int, strict_day))


def invalid_rows(raw: DataFrame, legacy_int: bool = False, strict_day: bool = False) -> DataFrame:
    return raw.filter(~is_valid(legacy_int, strict_day))


def typed_rows(valid: DataFrame, legacy_int: bool = False) -> DataFrame:
    """Cast and rename; account and ip are still there."""
    return valid.select(
        to_day("createRoomDate").alias(DAY),
        "method",
        to_int("ingametime", legacy_int).alias("current_time"),
        to_int("deathCount", legacy_int).alias("death_count"),
        F.col("roomID").alias("room_id"),
        to_instant("datetime").alias("datetime"),
        to_int("x", legacy_int).alias("x"),
        to_int("y", legacy_int).alias("y"),
        "inputkey",
        "champion",
        to_int("status", legacy_int).alias("status"),
        "account",
        "ip",
    )


def mask_identity(rows: DataFrame, salt: str | None = None) -> DataFrame:
    """Replace the account by its pseudonym and drop the address."""
    return rows.withColumn("encrypted_account", pseudonym("account", salt)).drop("account", "ip")


def bronze_rows(
    raw: DataFrame, salt: str | None = None, legacy_int: bool = False, strict_day: bool = False
) -> DataFrame:
    """Raw rows to the bronze table: accept, type, mask."""
    valid = valid_rows(raw, legacy_int, strict_day)
    return mask_identity(typed_rows(valid, legacy_int), salt)


def quarantine_rows(
    raw: DataFrame,
    clear: bool = False,
    salt: str | None = None,
    legacy_int: bool = False,
    strict_day: bool = False,
) -> DataFrame:
    """Refused rows with the day they belong to.

    By default the account is masked and the address dropped; ``clear`` keeps
    the 13 fields as they came. A kept message text holds both in clear, so it
    stays only with ``clear``.
    """
    refused = invalid_rows(raw, legacy_int, strict_day).withColumn(DAY, to_day("createRoomDate"))
    if clear:
        return refused
    return mask_identity(refused, salt).drop(MESSAGE_TEXT)


def split_rows(
    raw: DataFrame,
    salt: str | None = None,
    clear: bool = False,
    legacy_int: bool = False,
    strict_day: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(bronze, quarantine) branches of the same raw rows."""
    bronze = bronze_rows(raw, salt, legacy_int, strict_day)
    return bronze, quarantine_rows(raw, clear, salt, legacy_int, strict_day)


def raw_fields(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_FIELDS)


def drop_features(scored: DataFrame) -> DataFrame:
    return scored.drop(FEATURES)
