"""Versioned publication of a set of tables under one folder.

    <target>/_manifest/0000000003.json    version 3: the files of every table
    <target>/data/<run>/<table>/...       files of one build, never changed

A build writes into a run folder of its own and is published by **one rename**:
its manifest, written beside the others under a temporary name, gets the next
number.  Readers take the manifest with the highest number, so they see all
tables of one version or all of another, whatever a publisher does meanwhile.
A table's entry may name folders of earlier runs: what a refresh did not change
is carried over by name, not copied.

A build that dies before the rename leaves a run folder no manifest names, and
nothing else; ``recover`` removes such folders.  Two publishers that started
from the same version meet at the rename: the second gets ``PublishConflict``.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.folders import Folders

#: Versions kept for readers that resolved them earlier.
KEEP = 2
#: Seconds after which a run folder without a manifest counts as abandoned.
ABANDONED_AFTER = 24 * 3600
_NUMBER = re.compile(r"(\d{10})\.json")


class PublishConflict(RuntimeError):
    """Another build was published since this one started."""


@dataclass
class TableEntry:
    """Where a table's files are: folders below the target, one for the whole
    table or one per partition value (``parts``), and what is known of them."""

    folders: list[str]
    schema: dict
    fmt: str = "parquet"
    metrics: dict = field(default_factory=dict)
    parts: dict[str, dict] | None = None
    part_by: str | None = None


@dataclass
class Manifest:
    number: int
    tables: dict[str, TableEntry]
    notes: dict = field(default_factory=dict)

    def dump(self) -> str:
        return json.dumps({"number": self.number, "notes": self.notes,
                           "tables": {n: vars(t) for n, t in self.tables.items()}}, sort_keys=True)

    @classmethod
    def load(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(d["number"], {n: TableEntry(**t) for n, t in d["tables"].items()}, d["notes"])

    def runs(self) -> set[str]:
        return {f.split("/")[1] for t in self.tables.values() for f in t.folders}


class Versions:
    """The published versions under ``target``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.fs = Folders(self.target, spark)

    def path(self, relative: str) -> str:
        return f"{self.target}/{relative}"

    def numbers(self) -> list[int]:
        names = self.fs.names(self.path("_manifest"))
        return sorted(int(m.group(1)) for m in map(_NUMBER.fullmatch, names) if m)

    def load(self, number: int) -> Manifest:
        return Manifest.load(self.fs.read(self.path(f"_manifest/{number:010d}.json")))

    def current(self) -> Manifest | None:
        numbers = self.numbers()
        return self.load(numbers[-1]) if numbers else None

    def new_run(self) -> str:
        """A run folder's path below the target."""
        run = f"data/{uuid.uuid4().hex}"
        self.fs.mkdirs(self.path(run))
        return run

    def publish(self, tables: Mapping[str, TableEntry], base: Manifest | None, notes: dict | None = None) -> Manifest:
        """Make ``tables``, with the tables of ``base`` they do not replace, the
        next version after ``base``."""
        made = Manifest((base.number if base else 0) + 1, {**(base.tables if base else {}), **tables}, notes or {})
        draft = self.path(f"_manifest/draft-{uuid.uuid4().hex}")
        self.fs.mkdirs(self.path("_manifest"))
        self.fs.write(draft, made.dump())
        try:
            newest = self.numbers()[-1:]
            if newest and newest[0] >= made.number:
                raise PublishConflict(f"version {newest[0]} was published meanwhile")
            self.fs.rename(draft, self.path(f"_manifest/{made.number:010d}.json"))  # the one step that publishes
        except PublishConflict:
            self.fs.delete(draft)
            raise
        except Exception as e:
            self.fs.delete(draft)
            if made.number in self.numbers():
                raise PublishConflict(f"version {made.number} was published meanwhile") from e
            raise
        return made

    def retire(self, keep: int = KEEP) -> None:
        """Drop all but the newest ``keep`` versions, and the runs only they name."""
        numbers = self.numbers()
        kept = [self.load(n) for n in numbers[-keep:]]
        named = set().union(*(m.runs() for m in kept)) if kept else set()
        for n in numbers[:-keep]:
            gone = self.load(n).runs()
            # the manifest goes first: a version that is listed always has its files
            self.fs.delete(self.path(f"_manifest/{n:010d}.json"))
            for run in gone - named:
                self.fs.delete(self.path(f"data/{run}"))

    def recover(self, older_than: float = ABANDONED_AFTER) -> list[str]:
        """Remove what builds that died left behind: drafts, and run folders no
        manifest names, unchanged for ``older_than`` seconds."""
        limit = time.time() - older_than
        named = set().union(set(), *(self.load(n).runs() for n in self.numbers()))
        left = [f"data/{run}" for run, at in self.fs.names(self.path("data")).items() if run not in named and at <= limit]
        left += [f"_manifest/{n}" for n, at in self.fs.names(self.path("_manifest")).items()
                 if n.startswith("draft-") and at <= limit]
        for path in left:
            self.fs.delete(self.path(path))
        return left

    def read(self, manifest: Manifest, name: str) -> DataFrame:
        """A table of one version; its files do not change while it is kept."""
        entry = manifest.tables[name]
        schema = T.StructType.fromJson(entry.schema)
        paths = [self.path(f) for f in entry.folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if entry.fmt == "csv":
            return reader.option("header", True).option("escape", '"').option("multiLine", True).csv(paths)
        return reader.parquet(*paths)
