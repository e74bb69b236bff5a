"""Tables as generations of partitions, and one small manifest that says which of them count.

    root/<table>/gen=<generation>/date=<date>/part-*.parquet
    root/_manifest/<number>.json

A transaction writes new partitions as a generation of their own, beside those that count. Readers go
by the manifest with the highest number, so they see nothing of it until ``commit`` moves the next
manifest into place by one rename: then every table of the transaction changes at once, and a
failure at any moment leaves the state before or the state after. A frame read earlier keeps naming
the files of its own state; these stay until the commit after next. What a failed transaction left
behind is removed by the next commit. There is one writer at a time; readers need no lock.

The manifest holds one entry per table and partition (one per calendar date).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

KEPT = 2  # states whose files stay
WHOLE = ""  # the one part of a table without partitions


class Files:
    """The few file operations of a store, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> None:
        if self._fs.exists(self._path(new)) or not self._fs.rename(self._path(old), self._path(new)):
            raise RuntimeError(f"{new} could not be put in place: is there another writer?")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Store:
    """The tables below ``root`` in their newest state, and what this transaction has replaced since."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.files = Files(spark, root)
        numbers = self._numbers()
        self.number = numbers[-1] if numbers else 0
        self.state: dict[str, dict] = self._manifest(self.number) if numbers else {}

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.root}/_manifest") if re.fullmatch(r"[0-9]+\.json", n))

    def _name(self, number: int) -> str:
        return f"{self.root}/_manifest/{number:010d}.json"

    def _manifest(self, number: int) -> dict[str, dict]:
        return json.loads(self.files.read(self._name(number)))

    def parts(self, table: str) -> list[str]:
        """The partitions that a table has, in order."""
        return sorted(self.state.get(table, {"parts": {}})["parts"])

    def read(self, table: str, schema, first: str | None = None, last: str | None = None, values: Iterable | None = None) -> DataFrame:
        """A table, or its partitions in a closed range or among ``values``; only their files are listed.

        A folder that was not written by a store is read as it is, as long as the store has no such table.
        """
        if table not in self.state and any(n[0] not in "._" and not n.startswith("gen=") for n in self.files.names(f"{self.root}/{table}")):
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        known = self.state.get(table, {"by": None, "parts": {}})
        wanted = None if values is None else {str(v) for v in values}
        chosen = [
            (value, generation) for value, generation in sorted(known["parts"].items())
            if (wanted is None or value in wanted) and (first is None or value >= first) and (last is None or value <= last)
        ]
        empty = self.spark.createDataFrame([], schema)
        if not chosen:
            return empty
        base = f"{self.root}/{table}"
        paths = [f"{base}/gen={g}" + (f"/{known['by']}={v}" if known["by"] else "") for v, g in chosen]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*empty.columns)

    def replace(
        self, frames: dict[str, tuple[DataFrame, Sequence[str]]], affected: Iterable | None = None, by: str = "date"
    ) -> None:
        """Replace the affected partitions of several tables.

        ``frames``: table name to rows and sort columns. ``affected``: partition values beside those that
        have new rows in any of the tables; all of them lose their old rows in every table of the call.
        """
        generation, new = f"g{uuid.uuid4().hex}", {}
        for name, (rows, sort) in frames.items():
            folder = f"{self.root}/{name}/gen={generation}"
            # The runtime may split a crowded partition over several tasks and merge small ones.
            placed = rows.hint("rebalance", by)
            if sort:
                placed = placed.sortWithinPartitions(by, *sort)
            placed.write.partitionBy(by).parquet(folder)
            new[name] = [n.partition("=")[2] for n in self.files.names(folder) if n.startswith(f"{by}=")]
        changed = {str(v) for v in affected or ()}.union(*new.values())
        for name, values in new.items():
            parts = {v: g for v, g in self.state.get(name, {"parts": {}})["parts"].items() if v not in changed}
            self.state[name] = {"by": by, "parts": parts | dict.fromkeys(values, generation)}

    def put(self, table: str, rows: DataFrame) -> None:
        """Replace a small table without partitions."""
        generation = f"g{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{table}/gen={generation}")
        self.state[table] = {"by": None, "parts": {WHOLE: generation}}

    def commit(self) -> None:
        """Make the replaced partitions of all tables count, in one step."""
        text = json.dumps(self.state, sort_keys=True)
        beside = f"{self.root}/_manifest/.{uuid.uuid4().hex}"
        self.files.write(beside, text)
        self.files.rename(beside, self._name(self.number + 1))
        self.number += 1
        self.state = json.loads(text)
        self._clean()

    def _clean(self) -> None:
        """Remove partitions that no kept state names, and generations that no state ever named."""
        numbers = self._numbers()
        kept = [self._manifest(n) for n in numbers[-KEPT:]]
        alive = {(t, g, v) for state in kept for t, known in state.items() for v, g in known["parts"].items()}
        for number in numbers[:-KEPT]:
            for table, known in self._manifest(number).items():
                for value, generation in known["parts"].items():
                    if (table, generation, value) not in alive and known["by"]:
                        self.files.delete(f"{self.root}/{table}/gen={generation}/{known['by']}={value}")
        named = {(t, f"gen={g}") for t, g, _ in alive}
        for table in self.state:
            for name in self.files.names(f"{self.root}/{table}"):
                if name.startswith("gen=") and (table, name) not in named:
                    self.files.delete(f"{self.root}/{table}/{name}")
        for number in numbers[:-KEPT]:  # last, so that a clean-up that failed is done again
            self.files.delete(self._name(number))
        for name in self.files.names(f"{self.root}/_manifest"):
            if not re.fullmatch(r"\.?[0-9]+\.json(\.crc)?", name):
                self.files.delete(f"{self.root}/_manifest/{name}")
