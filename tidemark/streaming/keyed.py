"""A keyed table that can be read while it is written.

Rows lie in hash buckets of their key. A batch rewrites only the buckets its keys fall in, into a new generation's folder,
and then adds one manifest that names, for each bucket, the generation that holds it. A reader takes the newest manifest and
reads the files it names: all of one generation of the table, whatever is written meanwhile. Nothing is changed in place;
``vacuum`` removes what the newest manifests no longer name.

A manifest also records the last batch, so a batch that runs again after its manifest is there changes nothing, and one that
stopped earlier writes its generation anew. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches

BUCKET = "bucket"


@dataclass(frozen=True)
class Manifest:
    """Which generation holds each bucket; ``generation`` is the newest, -1 of an empty table."""

    generation: int = -1
    batch_id: int = -1
    buckets: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"generation": self.generation, "batch_id": self.batch_id, "buckets": self.buckets})

    @classmethod
    def parse(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["generation"], found["batch_id"], {int(b): g for b, g in found["buckets"].items()})


@dataclass(frozen=True)
class KeyedTable:
    """One row per ``key`` below ``folder``. ``buckets`` is fixed for the table's life.

    Choose ``buckets`` so that one bucket, at the table's final size, is read and written by a task with ease.
    """

    folder: str
    schema: T.StructType
    key: Sequence[str]
    buckets: int = 64

    def _manifests(self, spark: SparkSession) -> list[int]:
        path, files = batches._hadoop(spark, f"{self.folder}/manifests")
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self, spark: SparkSession, generation: int | None = None) -> Manifest:
        """The newest manifest, or that of a generation."""
        numbers = self._manifests(spark)
        if generation is None and not numbers:
            return Manifest()
        number = numbers[-1] if generation is None else generation
        path, files = batches._hadoop(spark, f"{self.folder}/manifests/{number}.json")
        stream = files.open(path)
        try:
            return Manifest.parse(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _switch(self, spark: SparkSession, manifest: Manifest) -> None:
        """Make a manifest the newest: written beside, then renamed, so that no reader sees part of it."""
        final, files = batches._hadoop(spark, f"{self.folder}/manifests/{manifest.generation}.json")
        beside, _ = batches._hadoop(spark, f"{self.folder}/manifests/.{manifest.generation}.json.new")
        out = files.create(beside, True)
        try:
            out.write(bytearray(manifest.text().encode()))
        finally:
            out.close()
        if not files.rename(beside, final):
            raise RuntimeError(f"another writer has made generation {manifest.generation}")

    def _data(self, generation: int) -> str:
        return f"{self.folder}/data/generation={generation}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _files(self, spark: SparkSession, manifest: Manifest, wanted: Sequence[int] | None = None) -> DataFrame:
        chosen = manifest.buckets if wanted is None else {b: manifest.buckets[b] for b in wanted if b in manifest.buckets}
        if not chosen:
            return spark.createDataFrame([], self.schema)
        paths = [f"{self._data(generation)}/{BUCKET}={bucket}" for bucket, generation in sorted(chosen.items())]
        return spark.read.schema(self.schema).parquet(*paths)

    def read(self, spark: SparkSession, generation: int | None = None) -> DataFrame:
        """The table as of its newest generation, or of an earlier one that is still kept."""
        return self._files(spark, self.manifest(spark, generation))

    def upsert(self, updates: DataFrame, batch_id: int, order: str | None = None) -> Manifest:
        """Put one batch of rows into the table; the newest by ``order`` wins, and any of them over the table's row.

        Without ``order`` a batch has at most one row per key, as an update stream does. Also a ``foreachBatch`` target.
        """
        spark = updates.sparkSession
        now = self.manifest(spark)
        if batch_id <= now.batch_id:
            return now
        updates = updates.persist()
        try:
            touched = sorted(row[0] for row in updates.select(self._bucket()).distinct().collect())
            generation = now.generation + 1
            if touched:
                new = updates.select(*self.schema.names, F.struct(F.col(order) if order else F.lit(0)).alias("version"))
                old = self._files(spark, now, touched)
                # the table's own rows have no version: a null one, which the least of all versions stands above
                old = old.withColumn("version", F.lit(None).cast(new.schema["version"].dataType))
                wrapped = new.unionByName(old).withColumn("version", F.struct(F.col("version").isNotNull(), "version"))
                rows = batches.last_wins(wrapped, self.key, "version").withColumn(BUCKET, self._bucket())
                rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._data(generation))
        finally:
            updates.unpersist()
        switched = Manifest(generation, batch_id, now.buckets | dict.fromkeys(touched, generation))
        self._switch(spark, switched)
        return switched

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Remove the manifests before the ``keep`` newest and the bucket folders none of these names; returns the folders."""
        numbers = self._manifests(spark)
        kept = [self.manifest(spark, number) for number in numbers[-keep:]]
        named = {(generation, bucket) for one in kept for bucket, generation in one.buckets.items()}
        for number in numbers[:-keep]:
            path, files = batches._hadoop(spark, f"{self.folder}/manifests/{number}.json")
            files.delete(path, False)
        root, files = batches._hadoop(spark, f"{self.folder}/data")
        removed = []
        if not kept or not files.exists(root):
            return removed
        for status in files.listStatus(root):
            generation = int(status.getPath().getName().rpartition("=")[2])
            if generation > kept[-1].generation:
                continue  # being written
            for inner in files.listStatus(status.getPath()):
                name = inner.getPath().getName()
                if name.startswith(f"{BUCKET}=") and (generation, int(name.rpartition("=")[2])) not in named:
                    files.delete(inner.getPath(), True)
                    removed.append(f"generation={generation}/{name}")
        return sorted(removed)
