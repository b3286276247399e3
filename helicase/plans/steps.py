"""Steps of a run that are written once and found again.

A step is a table under its name.  Beside it lies what it was made from: a digest of the settings and of the steps before
it.  A step whose digest has not changed is read; others, and all that follow them, are made anew.  Tables become visible
by their committer, the digest is written last, so a run that was cut off goes on from its last whole step.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from helicase.sources.store import discard, exists, located, put_text, text_of


@dataclass
class Steps:
    spark: SparkSession
    folder: str
    settings: dict = field(default_factory=dict)
    resume: bool = True
    #: Buckets of a step with a key; none: as many as spark.sql.shuffle.partitions.
    buckets: int | None = None
    #: From this step on everything is made anew.
    restart: str | None = None
    done: list[tuple[str, str]] = field(default_factory=list)
    _chain: str = ""
    _anew: bool = False

    def digest(self, name: str, more: dict | None = None) -> str:
        return hashlib.sha256(json.dumps([name, self.settings, more, self._chain], sort_keys=True, default=str).encode()).hexdigest()

    def step(self, name: str, make: Callable[[], DataFrame], more: dict | None = None, key: str | None = None) -> DataFrame:
        """The step's table: read if it is there and made from the same settings (and more of them), else made and written.

        With a key it lies in buckets of the key, in order inside them: joins of such steps and aggregates by the key take
        the rows as they lie.  A key should have few rows of one value, since they lie in one bucket.
        """
        told = {"more": more, "key": key, "buckets": self.count()} if key else more
        path, mark, digest = f"{self.folder}/{name}", f"{self.folder}/{name}.digest", self.digest(name, told)
        self._anew = self._anew or not self.resume or name == self.restart
        found = not self._anew and exists(self.spark, mark) and text_of(self.spark, mark) == digest
        if not found:
            self._anew = True
            discard(self.spark, mark)
            if key:
                self._in_buckets(make(), name, path, key)
            else:
                make().write.mode("overwrite").parquet(path)
            put_text(self.spark, mark, digest)
        self.done.append((name, "found" if found else "made"))
        self._chain = digest
        return self._table(name, path, key) if key else self.spark.read.parquet(path)

    def count(self) -> int:
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _called(self, name: str) -> str:
        return f"step_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}_{name}"

    def _in_buckets(self, rows: DataFrame, name: str, path: str, key: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._called(name)}")
        # one file a bucket, not one for each task and bucket
        out = rows.repartition(self.count(), key).write.mode("overwrite").format("parquet").option("path", path)
        out.bucketBy(self.count(), key).sortBy(key).saveAsTable(self._called(name))

    def _table(self, name: str, path: str, key: str) -> DataFrame:
        """The files as a table that knows their buckets; another session's catalogue may not have it yet."""
        if not self.spark.catalog.tableExists(self._called(name)):
            columns = self.spark._jsparkSession.parseDataType(self.spark.read.parquet(path).schema.json()).toDDL()
            found, store = located(self.spark, path)
            at = store.makeQualified(found).toString().replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {self._called(name)} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.count()} BUCKETS LOCATION '{at}'")
        return self.spark.table(self._called(name))

    def status(self) -> DataFrame:
        """name, state of the steps so far: found or made."""
        return self.spark.createDataFrame(self.done, "name string, state string")
