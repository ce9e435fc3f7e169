"""A table kept by key, changed by upserts that write only the parts they touch."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fieldtally.contracts import required, shape
from fieldtally.operators.ordering import keep_one
from fieldtally.session import file_system, settle
from fieldtally.sources.sinks import write_partitioned

_BATCH = "batch"


class KeyedTable:
    """Rows unique by ``keys``, in one folder per value of ``by``, which is one of the keys.

    An upsert writes the values of ``by`` that occur in its rows anew, into
    folders of its own, and then publishes a manifest that names the folder of
    every value. Readers follow the newest manifest, so they see a batch whole
    or not at all; folders of a batch that never published are not read.
    Batches count in the order in which they publish. One writer at a time: of
    two that publish the same number, the second fails.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], by: str):
        if by not in keys:
            raise ValueError(f"{by} must be one of the keys, or a key could stand in two places")
        self.spark, self.path, self.keys, self.by = spark, path, list(keys), by
        self.schema = shape(schema) if isinstance(schema, str) else schema

    def _manifests(self) -> list[tuple[int, str]]:
        files, pattern = file_system(self.spark, f"{self.path}/_manifests/*.json")
        paths = [entry.getPath() for entry in files.globStatus(pattern) or []]
        return sorted((int(p.getName().removesuffix(".json")), p.toString()) for p in paths)

    def _folders(self) -> dict[str, str]:
        """Value of ``by`` to its folder, by the newest manifest that is complete."""
        for _, path in reversed(self._manifests()):
            files, manifest = file_system(self.spark, path)
            stream = files.open(manifest)
            try:
                return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except json.JSONDecodeError:
                continue
            finally:
                stream.close()
        return {}

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField(_BATCH, T.LongType())])
        reader = self.spark.read.schema(whole).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        """The table as the newest manifest has it."""
        return self._read(list(self._folders().values()))

    def upsert(self, rows: DataFrame, seq: Sequence[str]) -> list[str]:
        """Insert ``rows`` or put them in the place of rows with their key; of several with one key the last in ``seq`` wins.

        Returns the values of ``by`` that were written. A NULL in a key or in
        a column that the schema requires fails the batch.
        """
        must = [f.name for f in self.schema.fields if f.name in self.keys or not f.nullable]
        latest = keep_one(required(rows, must, self.path), self.keys, seq, "last")
        batch = settle(latest.select(*[latest[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]), "batch")
        # One row per value that occurs in the batch.
        touched = {str(row[0]) for row in batch.select(batch[self.by].cast("string")).distinct().collect()}
        if not touched:
            return []
        folders = self._folders()
        old = self._read([folder for value, folder in folders.items() if value in touched])
        merged = old.join(batch.select(*self.keys), self.keys, "left_anti").unionByName(batch)
        number = max([n for n, _ in self._manifests()], default=0) + 1
        target = f"{_BATCH}={number}"
        write_partitioned(merged, f"{self.path}/{target}", self.by, "overwrite")
        files, written = file_system(self.spark, f"{self.path}/{target}/{self.by}=*")
        names = [entry.getPath().getName() for entry in files.globStatus(written)]
        folders |= {unquote(name.split("=", 1)[1]): f"{target}/{name}" for name in names}
        stream = files.create(file_system(self.spark, f"{self.path}/_manifests/{number:010d}.json")[1], False)
        stream.write(bytearray(json.dumps(folders), "utf-8"))
        stream.close()
        return sorted(touched)

    def expire(self) -> int:
        """Delete the folders that the newest manifest does not name; returns how many. No reader may be at work."""
        live = set(self._folders().values())
        files, pattern = file_system(self.spark, f"{self.path}/{_BATCH}=*/{self.by}=*")
        gone = [p for p in (entry.getPath() for entry in files.globStatus(pattern) or []) if f"{p.getParent().getName()}/{p.getName()}" not in live]
        for path in gone:
            files.delete(path, True)
        return len(gone)
