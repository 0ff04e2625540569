"""Stored tables whose slices are replaced as a whole.

A slice holds the rows of one combination of partition values, such as a snapshot date and a tenant. A commit writes the
new rows into a folder of its own and then one pointer file that names, for every slice, the folder that holds it now;
readers follow the pointer with the highest number. So a commit replaces exactly the slices it declares, also with
nothing; a job that dies before the pointer is written leaves the table as it was; files of other slices stay untouched;
and a job may read the table that it replaces.
"""

import json
import uuid
from collections.abc import Iterable, Iterator
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from patronage.sinks.writers import MAX_FILE_ROWS, cluster_by_snapshot

#: Partition values of slices: all slices that agree with the values given.
Scope = list[dict[str, object]]

_NONE = "__HIVE_DEFAULT_PARTITION__"
_VERSION = "_version"


def _text(value: object) -> str:
    return _NONE if value is None else value.isoformat() if isinstance(value, date) else str(value)


def covers(scope: Scope, values: dict[str, str]) -> bool:
    """Some entry of the scope agrees with the slice's values."""
    return any(all(values[k] == _text(v) for k, v in entry.items()) for entry in scope)


class VersionedTable:
    """A folder of versions, and pointers to the version of each slice."""

    def __init__(self, spark: SparkSession, path: str, parts: tuple[str, ...]):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, path: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._files.listStatus(self._hadoop.Path(path)) if f.isDirectory())

    def _pointers(self) -> list[str]:
        folder = self._hadoop.Path(f"{self.path}/_pointers")
        if not self._files.exists(folder):
            return []
        names = (f.getPath().getName() for f in self._files.listStatus(folder))
        return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))

    def pointer(self) -> dict:
        """The present schema and slices: partition values with the version that holds them."""
        names = self._pointers()
        if not names:
            return {"number": 0, "schema": None, "slices": []}
        return self._content(names[-1])

    def _content(self, name: str) -> dict:
        stream = self._files.open(self._hadoop.Path(f"{self.path}/_pointers/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self._pointers())

    def slices(self, scope: Scope | None = None) -> list[dict[str, str]]:
        """Partition values, as text, of the slices within the scope."""
        return [s["values"] for s in self.pointer()["slices"] if scope is None or covers(scope, s["values"])]

    def read(self, scope: Scope | None = None) -> DataFrame:
        """Rows of the slices within the scope. Only their folders are listed and read."""
        now = self.pointer()
        if now["schema"] is None:
            raise FileNotFoundError(f"nothing was ever committed to {self.path}")
        schema = StructType.fromJson(json.loads(now["schema"]))
        held = [f"{self.path}/{s['folder']}" for s in now["slices"] if scope is None or covers(scope, s["values"])]
        if not held:
            return self.spark.createDataFrame([], schema)
        full = StructType([*schema.fields, StructField(_VERSION, StringType())])
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*held).select(*schema.names)

    def _written(self, folder: str, depth: int = 0) -> Iterator[dict]:
        """Values and folder of the slices below a folder of the table."""
        if depth == len(self.parts):
            yield {"values": {}, "folder": folder}
            return
        for name in self._folders(f"{self.path}/{folder}"):
            if "=" in name:
                key, value = name.split("=", 1)
                for inner in self._written(f"{folder}/{name}", depth + 1):
                    yield {"values": {key: unquote(value), **inner["values"]}, "folder": inner["folder"]}

    def commit(self, rows: DataFrame, scope: Scope) -> None:
        """Replace the slices of the scope by the rows, which must lie within it."""
        before = self.pointer()
        folder = f"{_VERSION}={uuid.uuid4().hex}"
        columns = [c for c in rows.columns if c not in self.parts]
        rows = rows.select(*columns, *self.parts)
        clustered = cluster_by_snapshot(rows, list(self.parts))
        clustered.write.partitionBy(*self.parts).option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(f"{self.path}/{folder}")
        written = list(self._written(folder))
        for piece in written:
            if not covers(scope, piece["values"]):
                raise ValueError(f"rows of {piece['values']} lie outside the slices that {self.path} was to replace")
        kept = [s for s in before["slices"] if not covers(scope, s["values"])]
        schema = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
        self._point({"number": before["number"] + 1, "schema": json.dumps(schema.jsonValue()), "slices": kept + written})

    def _point(self, pointer: dict) -> None:
        """Make the pointer the present one: its file appears whole, by renaming."""
        name = f"{pointer['number']:012d}.json"
        hidden, shown = (self._hadoop.Path(f"{self.path}/_pointers/{n}") for n in (f".{uuid.uuid4().hex}", name))
        if self._files.exists(shown):
            raise RuntimeError(f"another job committed {name} to {self.path} meanwhile")
        stream = self._files.create(hidden, False)
        stream.write(bytearray(json.dumps(pointer), "utf-8"))
        stream.close()
        if not self._files.rename(hidden, shown):
            raise RuntimeError(f"another job committed {name} to {self.path} meanwhile")

    def clean(self, keep: int = 2) -> None:
        """Delete pointers but the last `keep` and the versions that none of them names."""
        names = self._pointers()
        kept = names[-keep:]
        used = set()
        for name in kept:
            used.update(s["folder"].split("/")[0] for s in self._content(name)["slices"])
        for name in set(names) - set(kept):
            self._files.delete(self._hadoop.Path(f"{self.path}/_pointers/{name}"), False)
        for folder in self._folders(self.path):
            if folder.startswith(f"{_VERSION}=") and folder not in used:
                self._files.delete(self._hadoop.Path(f"{self.path}/{folder}"), True)


def days(scope_days: Iterable[date], tenants: Iterable[str] | None = None) -> Scope:
    """Slices of snapshot dates, of all tenants or of some."""
    if tenants is None:
        return [{"stat_date": d} for d in scope_days]
    held = list(tenants)
    return [{"stat_date": d, "tenant": t} for d in scope_days for t in held]
