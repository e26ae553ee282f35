"""What a stage made, from which input: stages that are done and still valid are not run again.

Spark commits a stage's output as a whole, so a restart resumes between stages and never loses or repeats rows.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession

from loomgraph.config import MANIFEST_VERSION
from loomgraph.sources.csv_tables import Folder


class Manifest:
    def __init__(self, spark: SparkSession, output: str, source: str, options: dict):
        self.folder, self.source = Folder(spark, output), source
        self.spark = spark
        self.key = {"version": MANIFEST_VERSION, "input": source, "state": self._state(source), "output": output, "options": options}

    def _state(self, source: str) -> list:
        """Times and sizes of the input's files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(source)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            raise FileNotFoundError(source)
        return sorted([f.getPath().getName(), f.getModificationTime(), f.getLen()] for f in fs.listStatus(path))

    def done(self, stage: str, needs: str | None = None) -> dict | None:
        """What the stage reported, if it ran on the same input with the same options, and what it wrote (needs) is there; damaged records count as none."""
        body = self.folder.text(f".manifest/{stage}.json")
        if body is None or (needs and not self.folder.exists(needs)):
            return None
        try:
            kept = json.loads(body)
        except ValueError:
            return None
        return kept.get("result") if isinstance(kept, dict) and {k: kept.get(k) for k in self.key} == self.key else None

    def record(self, stage: str, result: dict) -> None:
        """Written under another name and moved, so it is there as a whole or not at all."""
        body = json.dumps(self.key | {"stage": stage, "at": time.time(), "result": result})
        self.folder.fs.mkdirs(self.folder._path(".manifest"))
        self.folder.put(f".manifest/{stage}.tmp", body)
        self.folder.move(f".manifest/{stage}.tmp", f".manifest/{stage}.json")

    def clear(self, stages: list[str] | None = None) -> None:
        """Forget some stages, or all."""
        for name in [".manifest"] if stages is None else [f".manifest/{s}.json" for s in stages]:
            self.folder.delete(name)
