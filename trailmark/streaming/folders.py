"""Folders of immutable data whose log names what is live."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


class VersionedFolder:
    """Data folders below ``path`` and a log of versions; a version counts once its folder holds ``_SUCCESS``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("log").getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _listed(self, name: str) -> list[str]:
        fs, top = self._fs(), self._path(name)
        return [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        numbers = sorted(int(m.group(1)) for n in self._listed("log") if (m := re.fullmatch(r"version=(\d+)", n)))
        fs = self._fs()
        return [n for n in numbers if fs.exists(self._path(f"log/version={n}/_SUCCESS"))]
