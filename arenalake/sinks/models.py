"""Stored pipelines, and a folder of their versions that a running stream follows."""

from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from arenalake.sinks.files import folder_names, make_folder

VERSION = "version="
#: In a version's folder once it is whole.
PUBLISHED = "_published"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@lru_cache(maxsize=4)
def _loaded(application: str, path: str) -> PipelineModel:
    return load_model(path)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(x.removeprefix(VERSION)) for x in folder_names(spark, folder) if x.startswith(VERSION))


def publish_model(spark: SparkSession, model: PipelineModel, folder: str) -> int:
    """Store ``model`` as the next version; readers see it when it is whole. Returns its number.

    Two that publish at once get the same number, and the second one fails.
    """
    number = max(_versions(spark, folder), default=0) + 1
    path = f"{folder}/{VERSION}{number}"
    model.write().save(f"{path}/model")
    make_folder(spark, f"{path}/{PUBLISHED}")
    return number


def current_model(spark: SparkSession, folder: str) -> tuple[int, PipelineModel]:
    """The last published version and its number. A version never changes, so it is loaded once."""
    for number in reversed(_versions(spark, folder)):
        path = f"{folder}/{VERSION}{number}"
        if PUBLISHED in folder_names(spark, path):
            return number, _loaded(spark.sparkContext.applicationId, f"{path}/model")
    raise FileNotFoundError(f"no model is published in {folder}")
