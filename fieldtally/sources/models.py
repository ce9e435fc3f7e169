"""Fitted models on shared storage, found again by what they were fitted on."""

from __future__ import annotations

import hashlib
import json
import threading
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from fieldtally.session import file_system, scratch_root


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A hash of name, length and time of change of every file below ``paths``; no file is opened."""
    seen = []
    for path in paths:
        files, folder = file_system(spark, path)
        entries = files.listFiles(folder, True)
        while entries.hasNext():
            entry = entries.next()
            seen.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(seen)).encode()).hexdigest()


class ModelStore:
    """Models by the files and settings they were fitted with.

    A model counts as stored once its marker, written last, is there; a save
    that was cut short is done again. Changed input files change the key, so
    the order in which queries run, or a removed scratch folder, never matters.
    """

    _locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def __init__(self, spark: SparkSession, inputs: Sequence[str], root: str | None = None):
        self.spark, self.inputs = spark, list(inputs)
        self.root = root or f"{scratch_root(spark)}/models"

    def path(self, settings: object) -> str:
        """The folder of the model with these settings on the files as they are now."""
        text = json.dumps([input_fingerprint(self.spark, self.inputs), settings], default=str)
        return f"{self.root}/{hashlib.sha256(text.encode()).hexdigest()}"

    def get(self, kind: type, fit: Callable[[], object], settings: object):
        """The stored model of class ``kind``, or the one that ``fit`` makes, stored."""
        path = self.path(settings)
        files, marker = file_system(self.spark, f"{path}/_complete")
        # One fit of a model at a time, for callers in several threads.
        with self._locks[path]:
            if files.exists(marker):
                return kind.load(f"{path}/model")
            model = fit()
            model.write().overwrite().save(f"{path}/model")
            files.create(marker, True).close()
            return model
