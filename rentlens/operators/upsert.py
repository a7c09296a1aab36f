"""Upsert by key: as a one-off DataFrame operation and as a stored table."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def delete_using(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not staged."""
    return target.join(stage.select(*keys).distinct(), list(keys), "left_anti")


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows replace all target rows of the same key. Repeats inside the
    stage all land, as they do with a delete followed by an insert."""
    return delete_using(target, stage, keys).select(target.columns).unionByName(stage)


@dataclass(frozen=True)
class Commit:
    """What one marker says: rows of `attempt` are write `number`, known by `key`."""

    number: int
    key: str
    attempt: str

    @property
    def name(self) -> str:
        return f"{self.number:012d}.{self.key}.{self.attempt}"


FOLDED = "folded"
#: A claim without a commit that is older than this does not hold up folding.
ABANDONED_MS = 24 * 3600 * 1000


class KeyedTable:
    """A table of commits, upserted by key without rewriting what is there.

    Each write goes into a fresh folder of its own, which readers do not see. One marker
    file makes it visible as a whole: its name holds the number of the commit, the
    writer's key for it, and the folder. Until then, and if checks stop it, the table is
    as it was. A write whose key was committed before takes the place and the number of
    that commit, so a replayed batch changes nothing; other keys follow after the last.

    A number is had by creating its claim, which must not exist yet, so two writers cannot
    have the same one; the store must refuse to create a file twice. Claims are made without
    gaps, and a fold takes only commits below every claim that is still open.

    Readers list the markers once and keep, for each key of a row, the rows of its newest
    commit. With `version`, the row of the largest version counts, whichever commit brought
    it: what arrives late does not replace what is newer, at any distance and over restarts.
    `compact` folds all but the newest commits into one, so the list stays short.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        version: Sequence[str] = (),
    ) -> None:
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.schema = schema
        self.version = list(version)

    def upsert(self, rows: DataFrame, key: str | int) -> None:
        self.commit(self.stage(rows), key)

    def stage(self, rows: DataFrame) -> str:
        """Write rows that readers do not see yet, so they can be checked first."""
        attempt = uuid.uuid4().hex
        rows.select(self.schema.fieldNames()).write.option("compression", "zstd").parquet(self._folder(attempt))
        return attempt

    def staged(self, attempt: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(attempt))

    def commit(self, attempt: str, key: str | int) -> None:
        name = re.sub(r"[^A-Za-z0-9_-]", "_", str(key))
        before = [c for c in self.commits() if c.key == name]
        commit = Commit(before[0].number if before else self._claim(), name, attempt)
        self._mark(commit)
        while commit not in self.commits():
            # A claim so old that a fold has gone past it; the number is taken anew.
            if any(c.key == name for c in self.commits()):
                break
            late, commit = commit, Commit(self._claim(), name, attempt)
            self._mark(commit)
            self._unmark(late)
        self._discard(before)

    def _claim(self) -> int:
        """The next number, which no other writer can have."""
        commits, claims = self._log()
        number = max([c.number for c in commits] + [*claims], default=0) + 1
        while not self._created(f"{self.path}/_log/{number:012d}"):
            number += 1
        return number

    def _created(self, path: str) -> bool:
        """Create a file, unless there is one: never twice, whoever else tries. Hadoop's local
        file system looks first and creates then, so local files are made by Java itself."""
        fs, hadoop_path = self._file_system()
        place = fs.makeQualified(hadoop_path(path))
        if fs.getUri().getScheme() == "file":
            fs.mkdirs(place.getParent())
            return self.spark._jvm.java.io.File(place.toUri().getPath()).createNewFile()
        try:
            fs.create(place, False).close()
            return True
        except Py4JJavaError:
            if fs.exists(place):
                return False
            raise

    def _log(self) -> tuple[list[Commit], dict[int, int]]:
        """What is committed and not folded, by number; and claims with their times. One
        list of small files."""
        fs, hadoop_path = self._file_system()
        folder = hadoop_path(f"{self.path}/_log")
        if not fs.exists(folder):
            return [], {}
        marks = sorted(fs.listStatus(folder), key=lambda s: (s.getModificationTime(), s.getPath().getName()))
        parts = [(s.getPath().getName().split("."), s.getModificationTime()) for s in marks]
        # Of two markers of one key, the later one counts: the other is being discarded.
        newest = {p[1]: Commit(int(p[0]), p[1], p[2]) for p, _ in parts if len(p) == 3}
        folded = max((c.number for c in newest.values() if c.key == FOLDED), default=0)
        live = [c for c in newest.values() if c.number > folded or c.key == FOLDED]
        claims = {int(p[0]): at for p, at in parts if len(p) == 1 and p[0].isdigit()}
        return sorted(live, key=lambda c: c.number), claims

    def commits(self) -> list[Commit]:
        return self._log()[0]

    def read(self) -> DataFrame:
        commits = self.commits()
        if not commits:
            return self.spark.createDataFrame([], self.schema)
        if len(commits) == 1:
            return self.staged(commits[0].attempt)
        numbered = [
            self.staged(c.attempt).withColumn("_commit", F.lit(c.number)) for c in commits
        ]
        rows = numbered[0]
        for more in numbered[1:]:
            rows = rows.unionByName(more)
        # Newest commit per key by partial maxima, then a semi join: a key with very
        # many rows is split by the adaptive skew join, never gathered.
        if self.version:
            rows = rows.withColumn("_commit", F.struct(*self.version, "_commit"))
        newest = rows.groupBy(*self.keys).agg(F.max("_commit").alias("_commit"))
        return rows.join(newest, [*self.keys, "_commit"], "left_semi").select(
            self.schema.fieldNames()
        )

    def compact(
        self,
        keep: int = 1,
        where: Column | None = None,
        change: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Fold all but the newest `keep` commits into one, with only those of their rows
        for which `where` holds, and as `change` makes them. The newest stay, since they may
        be replayed."""
        commits, claims = self._log()
        done = {c.number for c in commits}
        youngest = time.time() * 1000 - ABANDONED_MS
        folded = max((c.number for c in commits if c.key == FOLDED), default=0)
        open_ = [n for n, at in claims.items() if n > folded and n not in done and at > youngest]
        least = min(open_, default=None)
        old = [c for c in commits[: max(0, len(commits) - keep)] if least is None or c.number < least]
        if len(old) < 2:
            return
        rows = _Selected(self, old).read()
        rows = rows if where is None else rows.filter(where)
        attempt = self.stage(rows if change is None else change(rows))
        fold = Commit(old[-1].number, FOLDED, attempt)
        self._mark(fold)
        self._discard(old)
        fs, hadoop_path = self._file_system()
        for number in claims:
            if number < fold.number:
                fs.delete(hadoop_path(f"{self.path}/_log/{number:012d}"), False)

    def discard(self, attempt: str) -> None:
        """Delete what was staged and is not to be committed."""
        fs, hadoop_path = self._file_system()
        fs.delete(hadoop_path(self._folder(attempt)), True)

    def _mark(self, commit: Commit) -> None:
        fs, hadoop_path = self._file_system()
        fs.create(hadoop_path(f"{self.path}/_log/{commit.name}"), True).close()

    def _unmark(self, commit: Commit) -> None:
        fs, hadoop_path = self._file_system()
        fs.delete(hadoop_path(f"{self.path}/_log/{commit.name}"), False)

    def _discard(self, commits: Sequence[Commit]) -> None:
        """Markers first, so that no reader finds one without its rows."""
        fs, hadoop_path = self._file_system()
        for commit in commits:
            self._unmark(commit)
        for commit in commits:
            fs.delete(hadoop_path(self._folder(commit.attempt)), True)

    def _folder(self, attempt: str) -> str:
        return f"{self.path}/attempt={attempt}"

    def _file_system(self):
        context = self.spark.sparkContext
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path
        return hadoop_path(self.path).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


class _Selected(KeyedTable):
    """The table as some of its commits make it."""

    def __init__(self, table: KeyedTable, commits: Sequence[Commit]) -> None:
        super().__init__(table.spark, table.path, table.schema, table.keys, table.version)
        self._commits = list(commits)

    def commits(self) -> list[Commit]:
        return self._commits
