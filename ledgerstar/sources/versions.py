"""Versions of a data set in folders of their own, published by numbered commit records.

A writer fills a new folder and at last creates one small record, which names the folder.
Readers take the newest record, so they see an old version whole or a new one whole. Records
are numbered, and a writer may only create the number after the one it began with: of two
writers that began alike one wins, and the other gets `Conflict`. A record that was never
filled, because its writer was lost, names nothing and is passed over.

Creating a file only where there is none is atomic in HDFS and in object stores with
conditional writes, and on a local disk by exclusive creation.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

_STAMP = "%Y%m%dT%H%M%S"


class Conflict(RuntimeError):
    """Another writer has published since this one began."""


def new_version() -> str:
    """A name that tells when its writer began."""
    return f"{datetime.now(timezone.utc):{_STAMP}}-{uuid.uuid4().hex[:8]}"


def begun_at(version: str) -> datetime | None:
    try:
        return datetime.strptime(version.split("-")[0], _STAMP).replace(tzinfo=timezone.utc)
    except ValueError:
        return None


@dataclass(frozen=True)
class Commit:
    number: int
    version: str
    published_at: datetime
    facts: dict = field(default_factory=dict)


class VersionLog:
    """Versions below `root/folder` and the records below `root/commits`."""

    def __init__(self, spark: SparkSession, root: str, folder: str = "versions"):
        self.spark, self.root, self.folder = spark, root.rstrip("/"), folder
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils.toString
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, version: str) -> str:
        return f"{self.root}/{self.folder}/{version}"

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self.root}/{folder}")
        if not self._files.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(place))

    def _record(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("commits") if n.endswith(".json")]

    def _read(self, number: int) -> Commit | None:
        stream = self._files.open(self._path(self._record(number)))
        try:
            held = json.loads(self._text(stream, "UTF-8") or "null")
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()
        if held is None:
            return None
        return Commit(number, held["version"], datetime.fromisoformat(held["published_at"]), held["facts"])

    def _create(self, place, text: str) -> None:
        """Write a new file; it is an error if it is there.

        Hadoop's local file system looks first and creates then, so two writers may both
        succeed; there the file is opened for exclusive creation instead.
        """
        if self._files.getUri().getScheme() == "file":
            path = place.toUri().getPath()
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "x", encoding="utf-8") as file:
                file.write(text)
            return
        stream = self._files.create(place, False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def last_number(self) -> int:
        """What a writer has to know when it begins."""
        return max(self._numbers(), default=0)

    def history(self) -> list[Commit]:
        return [c for c in map(self._read, sorted(self._numbers())) if c]

    def newest(self) -> Commit | None:
        for number in sorted(self._numbers(), reverse=True):
            if commit := self._read(number):
                return commit
        return None

    def publish(self, version: str, after: int, facts: dict | None = None) -> Commit:
        """Make the version the newest one, unless another was published after record `after`."""
        if not self._files.exists(self._path(self.path(version))):
            raise FileNotFoundError(f"version {version} is not there, or was removed meanwhile")
        place = self._path(self._record(after + 1))
        stamp = datetime.now(timezone.utc)
        held = {"version": version, "published_at": stamp.isoformat(), "facts": facts or {}}
        if self.last_number() > after:
            raise Conflict(f"{version} began after record {after}, and there is a later one")
        try:
            self._create(place, json.dumps(held))
        except Exception as refused:  # the gateway wraps what the file system throws
            if self._files.exists(place):
                raise Conflict(f"another writer has taken record {after + 1}") from refused
            raise
        return Commit(after + 1, version, stamp, held["facts"])

    def collect(self, grace: timedelta, now: datetime | None = None) -> list[str]:
        """Remove versions nobody can need any more, and give their names.

        These are versions superseded longer than `grace` ago, which leaves that time to readers
        that opened them, and versions never published whose writers began longer ago than that.
        The newest version stays, and so does any folder whose name tells no time.
        """
        now = now or datetime.now(timezone.utc)
        commits = self.history()
        ended = {c.version: later.published_at for c, later in zip(commits, commits[1:])}
        if commits:
            ended.pop(commits[-1].version, None)
        published = {c.version for c in commits}
        removed = []
        for version in self._names(self.folder):
            since = ended.get(version) if version in published else begun_at(version)
            if since is not None and since + grace < now:
                self._files.delete(self._path(self.path(version)), True)
                removed.append(version)
        for commit in commits[:-1]:
            if commit.version in removed:
                self._files.delete(self._path(self._record(commit.number)), False)
        return removed
