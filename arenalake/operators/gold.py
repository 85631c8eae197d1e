"""Daily aggregates of the analysis table.

Every table is one aggregate of the events: added up before the shuffle, with one
exchange, reading only its own columns.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.functions.features import share
from arenalake.schema import DAY

USED_KEY = "alt"  # fixed value


def _measures() -> dict[str, Column]:
    return {
        "deaths_mean": F.avg("death_count"),
        "deaths_max": F.max("death_count"),
        "time_mean": F.avg("current_time"),
        "time_max": F.max("current_time"),
        "used": F.count(F.when(F.col("inputkey") == USED_KEY, True)),
        "total": F.count("*"),
        "stddev_x": F.stddev("x"),
        "stddev_y": F.stddev("y"),
    }


def summarise(silver: DataFrame, keys) -> DataFrame:
    """All measures per key. Measures a caller drops are not computed."""
    return silver.groupBy(*keys).agg(*[m.alias(name) for name, m in _measures().items()])


@dataclass(frozen=True)
class GoldTable:
    """``order`` is that of the rows inside every written file."""

    keys: tuple[str, ...]
    columns: tuple[Column | str, ...]
    order: tuple[str, ...] = ()

    def from_events(self, silver: DataFrame) -> DataFrame:
        return summarise(silver, self.keys).select(*self.keys, *self.columns)


def gold_tables() -> dict[str, GoldTable]:
    """The gold tables by name."""
    return {
        "average_death_and_time": GoldTable(
            ("encrypted_account", "champion", DAY),
            (
                F.col("deaths_mean").alias("average_deaths"),
                F.col("time_mean").alias("average_game_time"),
            ),
        ),
        "champion_death_count": GoldTable(
            ("room_id", "champion", DAY),
            (F.col("deaths_max").alias("death_count"),),
            order=(DAY, "room_id"),
        ),
        "key_used_per": GoldTable(
            ("champion", DAY),
            ("used", "total", share("used", "total").alias("total_q")),
        ),
        "room_end_time": GoldTable(
            ("room_id", DAY),
            (F.col("time_max").alias("end_time"),),
        ),
        "room_champion_xy": GoldTable(
            ("room_id", "encrypted_account", "champion", DAY), ("stddev_x", "stddev_y")
        ),
    }


def gold_from_events(silver: DataFrame, name: str) -> DataFrame:
    return gold_tables()[name].from_events(silver)
