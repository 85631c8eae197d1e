"""Names and places of the tables."""

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Table -> database it lives in.
TABLES = {
    "playerlogs": "bronze",
    "invalid_data": "bronze",
    "analysis_playerlogs": "silver_analysis",
    "train_playerlogs": "silver_train",
    "delta_playerlogs": "silver_train",
    "average_death_and_time": "gold",
    "champion_death_count": "gold",
    "key_used_per": "gold",
    "room_end_time": "gold",
    "room_champion_xy": "gold",
}

GOLD_TABLES = [table for table, database in TABLES.items() if database == "gold"]


@dataclass(frozen=True)
class Lake:
    """One set of tables below ``root``.

    Databases are ``bronze``, ``silver_analysis``, ``silver_train`` and ``gold``,
    each followed by ``suffix``. ``names`` maps single tables to names of
    existing tables elsewhere. ``fmt`` is the table format of all of them.
    """

    root: str
    suffix: str = ""
    fmt: str = "parquet"
    names: dict = field(default_factory=dict)

    def name(self, table: str) -> str:
        return self.names.get(table) or f"{TABLES[table]}{self.suffix}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table]}/{table}"

    def checkpoint(self, table: str) -> str:
        return self.checkpoint_of(f"{TABLES[table]}/{table}")

    def checkpoint_of(self, query: str) -> str:
        return f"{self.root}/checkpoint/{query}"

    @property
    def model_path(self) -> str:
        return f"{self.root}/model"

    @property
    def models_path(self) -> str:
        """The folder of published model versions."""
        return f"{self.root}/models"

    @property
    def archive_path(self) -> str:
        return f"{self.root}/archive"

    def create_databases(self, spark: SparkSession) -> None:
        for database in dict.fromkeys(TABLES.values()):
            name = f"{database}{self.suffix}"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/{database}'")
