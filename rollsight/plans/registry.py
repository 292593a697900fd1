"""Model versions: the metrics table and the stored models a running job picks up."""

from __future__ import annotations

import json

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession

from .. import contract as C
from ..sources import markers as K
from ..sources.tables import append_batch, read_batches, upserted
from .scoring import Model


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    store, location = _hadoop(spark, path)
    return store.exists(location)


def make_folder(spark: SparkSession, path: str) -> None:
    store, location = _hadoop(spark, path)
    store.mkdirs(location)


def numbered_folders(spark: SparkSession, path: str, name: str, inner: str = "") -> list[int]:
    """Numbers n for which `path/name=n` (and `inner` below it) exists, ascending."""
    pattern = f"{path}/{name}=*" + (f"/{inner}" if inner else "")
    store, location = _hadoop(spark, pattern)
    found = []
    for status in store.globStatus(location) or []:
        folder = status.getPath().getParent() if inner else status.getPath()
        found.append(int(folder.getName().split("=", 1)[1]))
    return sorted(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each version; empty before the first publication."""
    if not exists(spark, path) or not numbered_folders(spark, path, "batch_id"):
        return spark.createDataFrame([], C.REGISTRY_SCHEMA)
    return upserted(read_batches(spark, path), ["version"]).drop("batch_id")


def register(row: DataFrame, path: str) -> None:
    """Insert or update a version: the row goes under a new batch, readers take the last.

    The batch number is claimed, so registrations at the same time never write to one folder.
    """
    spark = row.sparkSession
    used = numbered_folders(spark, path, "batch_id")
    number = K.claim_number(spark, f"{path}/_claims", "batch", used[-1] + 1 if used else 0)
    append_batch(row, path, number, by_day=False)


def claim_version(spark: SparkSession, path: str) -> int:
    """The next free version, now belonging to the caller; two trainings never get the same one.

    A training that fails leaves its number unused.
    """
    newest = read_registry(spark, path).agg({"version": "max"}).first()[0] or 0
    return K.claim_number(spark, f"{path}/_claims", "version", newest + 1)


def save_model(spark: SparkSession, model: Model, root: str) -> None:
    """Metadata, then the classifiers, then the marker that makes the version visible."""
    folder = f"{root}/version={model.version}"
    write_text(spark, f"{folder}/meta", json.dumps(model.meta()))
    for family, classifier in model.classifiers.items():
        if classifier is not None:
            classifier.write().overwrite().save(f"{folder}/{family}")
    write_text(spark, f"{folder}/ready", str(model.version))


def load_model(spark: SparkSession, root: str, version: int) -> Model:
    folder = f"{root}/version={version}"
    meta = json.loads(read_text(spark, f"{folder}/meta"))
    wrong = C.contract_mismatches(meta.get("features", []), meta.get("labels", []))
    if wrong:
        raise C.ContractError(f"model {version}: {'; '.join(wrong)}")
    trained = {f: GBTClassificationModel.load(f"{folder}/{f}") for f in meta["trained"]}
    return Model(
        version=int(meta["version"]), classifiers=trained, threshold=meta["threshold"],
        trained_at=meta["trained_at"], trained_on=meta["trained_on"], metrics=meta["metrics"],
    )


class CurrentModel:
    """The model a running job scores with. `refresh` once per micro-batch: every row of a
    batch then carries one version. A version of another contract is skipped for good, one that
    cannot be read is tried again the next time; the model in use stays meanwhile."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.model: Model | None = None
        self.rejected: dict[int, str] = {}  # versions of another contract, never tried again
        self.unread: dict[int, str] = {}  # versions that could not be read, tried at each refresh

    def at(self, batch_id: int, journal: str) -> Model | None:
        """The model of a micro-batch: the newest one, noted under the batch's number before it
        scores; a batch that is run again takes the one noted for it, whatever is newer by then.

        A noted version that can no longer be read raises an error, as other scores would be wrong.
        """
        entry = f"{journal}/batch_id={batch_id}"
        noted = K.text_of(self.spark, entry)
        if not noted:
            newest = self.refresh()
            K.swap_text(self.spark, entry, str(newest.version if newest else 0))
            return newest
        version = int(noted)
        if version == 0:
            return None
        if self.model is not None and self.model.version == version:
            return self.model
        return load_model(self.spark, self.root, version)

    def refresh(self) -> Model | None:
        visible = numbered_folders(self.spark, self.root, "version", "ready")
        current = self.model.version if self.model else 0
        for version in reversed([v for v in visible if v > current and v not in self.rejected]):
            try:
                self.model = load_model(self.spark, self.root, version)
                self.unread.pop(version, None)
                break
            except C.ContractError as problem:
                self.rejected[version] = str(problem)
            except Exception as problem:  # an artifact that cannot be read now must not stop the job
                self.unread[version] = str(problem)
        return self.model
