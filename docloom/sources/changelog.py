"""Tables that change in small steps, kept as a log of commits on immutable files: many writers, many readers.

A commit is a small file named by its version. It is written aside and then put in its place by a step that fails if the
place is taken, so of two writers that prepared the same version one wins; the other reads the new state, computes its
change again and tries the next version. Data files are written before their commit and never changed after it, so a
reader sees whole versions only, and a writer that dies leaves files that nothing refers to.

`ChangeLog` is a table with a key: a bucketed base and deltas of changed rows, merged on read. Compaction rewrites only the
buckets that deltas touch. `Journal` is a table that is only added to: rows by step, merged level by level, so that a row
is rewritten as often as the logarithm of the number of steps. Steps carry marks, so that one that runs again is known.

The exclusive step is a hard link on a local or mounted file system and a rename elsewhere (which HDFS refuses if the
target exists; on a store whose rename doesn't, one writer is allowed only).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Deltas or pieces of one level that are merged into one.
MERGE_AFTER = 24
#: Changed rows up to which their keys are broadcast to the base.
BROADCAST_ROWS = 500_000
#: Marks without a number that a compaction keeps, the latest.
KEPT_MARKS = 1000


class Folder:
    """Small files in a shared folder, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path.rstrip("/"), spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.fs.getScheme() == "file"

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.fs.exists(self._at("")):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self._at(""))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Puts a file in its place whole; False if there is one already."""
        aside = f".{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self._at(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.local:
                plain = lambda n: urlparse(self._at(n).toUri().toString()).path
                try:
                    os.link(plain(aside), plain(name))
                except FileExistsError:
                    return False
                return True
            return bool(not self.fs.exists(self._at(name)) and self.fs.rename(self._at(aside), self._at(name)))
        finally:
            self.fs.delete(self._at(aside), False)

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


@dataclass
class State:
    """A table at a version: the pieces of its base, and the deltas after it as (version, folder, rows, mark)."""

    version: int = 0
    upto: int = 0
    base: dict = field(default_factory=dict)
    deltas: list[tuple[int, str, int, str | None]] = field(default_factory=list)
    numbers: dict[str, int] = field(default_factory=dict)
    marks: list[str] = field(default_factory=list)

    def noted(self, mark: str | None) -> None:
        if mark:
            name, _, number = mark.rpartition("/")
            if name and number.isdigit():
                self.numbers[name] = max(self.numbers.get(name, -1), int(number))
            else:
                self.marks.append(mark)

    def has(self, mark: str) -> bool:
        """Whether a step of this mark was committed; of numbered ones, one that is as late."""
        name, _, number = mark.rpartition("/")
        return self.numbers.get(name, -1) >= int(number) if name and number.isdigit() else mark in self.marks


class Log:
    """Commits at a path."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.names = T.StructType.fromDDL(schema).names
        self.folder = Folder(spark, f"{self.path}/log")
        self.commits: dict[int, dict] = {}

    def _commit(self, version: int) -> dict:
        if version not in self.commits:
            self.commits[version] = json.loads(self.folder.read(f"{version:020d}"))
        return self.commits[version]

    def state(self, version: int | None = None) -> State:
        """The table's state now, or at an earlier version that is still kept."""
        versions = sorted(int(n) for n in self.folder.names() if n.isdigit() and (version is None or int(n) <= version))
        if not versions:
            return State()
        found, later = State(), []
        for v in reversed(versions):  # back to the last base, and on to the deltas that it doesn't hold
            if v <= found.upto:
                break
            commit = self._commit(v)
            if "base" in commit:
                if not found.upto:
                    found = State(upto=commit["upto"], base=commit["base"], numbers=dict(commit["numbers"]), marks=list(commit["marks"]))
            else:
                later.append((v, commit))
        for v, commit in reversed(later):
            if v > found.upto:
                found.deltas.append((v, commit["folder"], commit["rows"], commit["mark"]))
            found.noted(commit["mark"])
        found.version = versions[-1]
        return found

    def version(self) -> int:
        return self.state().version

    def has(self, mark: str) -> bool:
        return self.state().has(mark)

    def _files(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{x}" for x in folders]) if folders else self.spark.createDataFrame([], schema)

    def _written(self, rows: DataFrame, *parts: str) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy(*parts).parquet(f"{self.path}/{folder}")
        return folder

    def _claim(self, version: int, commit: dict) -> bool:
        return self.folder.create(f"{version:020d}", json.dumps(commit))

    def _claim_base(self, before: State, base: dict) -> bool:
        """Commits a base that holds the deltas of `before`; others may have committed more deltas meanwhile, but no base."""
        held = State(numbers=dict(before.numbers), marks=list(before.marks))
        commit = {"base": base, "upto": before.version, "numbers": held.numbers, "marks": held.marks[-KEPT_MARKS:]}
        version = before.version
        while True:
            version += 1
            if self._claim(version, commit):
                return True
            if "base" in self._commit(version):
                return False

    def used(self, state: State) -> set[str]:
        """The data folders that a state refers to."""
        return {x[1] for x in state.deltas} | {self._root(x) for x in self._pieces(state)}

    @staticmethod
    def _root(folder: str) -> str:
        return "/".join(folder.split("/")[:2])

    def _pieces(self, state: State) -> list[str]:
        raise NotImplementedError

    def vacuum(self, keep: int = 64) -> None:
        """Deletes commits and data that no state of the last `keep` versions refers to. No writer should be under way with data of its own for longer than those."""
        now = self.state()
        first = max(1, now.version - keep + 1)
        oldest = self.state(first)
        if not oldest.upto:
            return
        commits = [self._commit(v) for v in range(oldest.upto + 1, now.version + 1)]
        used = self.used(oldest) | {c["folder"] for c in commits if "folder" in c}
        for c in commits:
            if "base" in c:
                used |= {self._root(x) for x in self._pieces(State(base=c["base"]))}
        gone = [int(n) for n in self.folder.names() if n.isdigit() and int(n) <= oldest.upto]
        for v in gone:  # what they brought and nothing later uses
            commit = self._commit(v)
            own = {commit["folder"]} if "folder" in commit else {self._root(x) for x in self._pieces(State(base=commit["base"]))}
            for x in own - used:
                Folder(self.spark, f"{self.path}/data").delete(x.removeprefix("data/"))
        for v in gone:
            self.folder.delete(f"{v:020d}")
            self.commits.pop(v, None)


class ChangeLog(Log):
    """A table with a key. `change` is how it is written: from the table to the rows that are new or other than before."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64, alive: str = "true"):
        """Rows for which `alive` doesn't hold are gone: a reader doesn't see them, and a compaction drops them."""
        super().__init__(spark, path, schema)
        self.key, self.buckets, self.alive = key, buckets, alive

    def _pieces(self, state: State) -> list[str]:
        return list(state.base.values())

    def _latest(self, state: State) -> DataFrame:
        rows = self._files([x[1] for x in state.deltas], f"{self.schema}, own_version long")
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*self.names), "own_version").alias("row"))
        return last.select("row.*")

    def _merged(self, base: DataFrame, state: State) -> DataFrame:
        if not state.deltas:
            return base.select(*self.names)
        latest = self._latest(state)
        keys = latest.select(self.key)
        keys = F.broadcast(keys) if sum(x[2] for x in state.deltas) <= BROADCAST_ROWS else keys
        return base.join(keys, self.key, "left_anti").select(*self.names).unionByName(latest.where(self.alive))

    def read(self, version: int | None = None, state: State | None = None) -> DataFrame:
        state = state or self.state(version)
        return self._merged(self._files(self._pieces(state), self.schema), state)

    def change(self, step: Callable[[DataFrame], DataFrame | None], mark: str | None = None, tries: int = 100) -> int | None:
        """Commits the rows of `step(table)`, computed anew for each version that another writer took first. None if the mark is there or the step returns None."""
        for _ in range(tries):
            state = self.state()
            if mark and state.has(mark):
                return None
            rows = step(self.read(state=state))
            if rows is None:
                return None
            version = state.version + 1
            folder = self._written(rows.select(*self.names).withColumn("own_version", F.lit(version).cast("long")))
            count = self._files([folder], self.schema).count()
            if self._claim(version, {"folder": folder, "rows": count, "mark": mark}):
                if len(state.deltas) + 1 >= MERGE_AFTER:
                    self.compact()
                return version
            Folder(self.spark, f"{self.path}/data").delete(folder.removeprefix("data/"))
        raise TimeoutError(f"{tries} versions were taken by other writers")

    def compact(self) -> bool:
        """Puts the deltas into the buckets that they touch; the others stay where they are."""
        state = self.state()
        if not state.deltas:
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        latest = self._latest(state).withColumn("own_bucket", bucket)
        touched = [str(r[0]) for r in latest.select("own_bucket").distinct().collect()]
        old = self._files([state.base[b] for b in touched if b in state.base], self.schema)
        rows = self._merged(old, state).withColumn("own_bucket", bucket)
        folder = self._written(rows.repartition(F.col("own_bucket")), "own_bucket")
        return self._claim_base(state, state.base | {b: f"{folder}/own_bucket={b}" for b in touched})


class Journal(Log):
    """A table that is only added to. Rows of one mark stand once: a step that runs again replaces its own rows.

    Merged pieces keep the version of each row, so that what was added after a version can be told at any time.
    """

    def _pieces(self, state: State) -> list[str]:
        return [folder for level in state.base.values() for folder, _ in level]

    def _added(self, state: State, after: int = 0) -> DataFrame:
        """(rows, own_version) after a version: of merged pieces that go beyond it, and of the last delta of each mark."""
        last = {mark or f"#{v}": (v, folder) for v, folder, _, mark in state.deltas}
        pieces = [folder for level in state.base.values() for folder, newest in level if newest > after]
        rows = self._files(pieces, f"{self.schema}, own_version long").where(F.col("own_version") > after)
        for v, folder in last.values():
            if v > after:
                rows = rows.unionByName(self._files([folder], self.schema).withColumn("own_version", F.lit(v).cast("long")))
        return rows

    def read(self, version: int | None = None) -> DataFrame:
        return self._added(self.state(version)).select(*self.names)

    def since(self, version: int) -> tuple[int, DataFrame]:
        """(the version now, the rows added after `version`): only pieces that hold such rows are read."""
        state = self.state()
        return state.version, self._added(state, version).select(*self.names)

    def append(self, rows: DataFrame, mark: str | None = None, tries: int = 100) -> int | None:
        """Commits the rows; None if those of this mark have been merged already."""
        folder = None
        for _ in range(tries):
            state = self.state()
            if mark and state.has(mark) and all(x[3] != mark for x in state.deltas):
                return None
            folder = folder or self._written(rows.select(*self.names))
            if self._claim(state.version + 1, {"folder": folder, "rows": -1, "mark": mark}):
                if len(state.deltas) + 1 >= MERGE_AFTER:
                    self.compact()
                return state.version + 1
        raise TimeoutError(f"{tries} versions were taken by other writers")

    def compact(self) -> bool:
        """Merges the added rows into a piece of level 0, and the pieces of a level that has enough of them into one of the next."""
        state = self.state()
        if not state.deltas:
            return False
        levels = {int(k): list(v) for k, v in state.base.items()}
        rows, level, merged = self._added(State(deltas=state.deltas)), 0, []
        while len(levels.get(level, [])) + 1 >= MERGE_AFTER:
            merged += [folder for folder, _ in levels.pop(level)]
            level += 1
        rows = rows.unionByName(self._files(merged, f"{self.schema}, own_version long")).coalesce(max(1, len(merged) // 8))
        levels.setdefault(level, []).append((self._written(rows), state.version))
        return self._claim_base(state, {str(k): v for k, v in levels.items()})


def only_missing(read: Callable[[], DataFrame], none: Callable[[], DataFrame]) -> DataFrame:
    """What `read` gives; what `none` gives if the path isn't there. Other faults stay faults."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none()
