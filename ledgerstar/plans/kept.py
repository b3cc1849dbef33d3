"""Kept results of views: persisted frames that expire and follow the published version."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgerstar.plans.views import VIEWS
from ledgerstar.sources.tables import current_version, read_star

KEEP_SECONDS = 300.0


@dataclass
class _Kept:
    frame: DataFrame
    version: str
    until: float


class ViewKeeper:
    """Results of one warehouse's views, kept for a time on the executors.

    A view is computed when first read and persisted; reads within `seconds` run on what is
    kept. A read looks up the published version (one small file), so results of an older
    version are never returned, and drops what has expired or belongs to an older version.
    Parts that a lost executor held are computed again from the tables of their version.
    """

    def __init__(
        self, spark: SparkSession, root: str, seconds: float = KEEP_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.spark, self.root, self.seconds, self.clock = spark, root, seconds, clock
        self._kept: dict[str, _Kept] = {}

    def read(self, view: str) -> DataFrame:
        version = current_version(self.spark, self.root)
        self._drop(lambda k: k.version != version or k.until <= self.clock())
        if view not in self._kept:
            frame = VIEWS[view](read_star(self.spark, self.root, version))
            frame.persist(StorageLevel.MEMORY_AND_DISK)
            self._kept[view] = _Kept(frame, version, self.clock() + self.seconds)
        return self._kept[view].frame

    def names(self) -> list[str]:
        return sorted(self._kept)

    def release(self) -> None:
        """Give back the storage of everything that is kept."""
        self._drop(lambda _: True)

    def _drop(self, stale: Callable[[_Kept], bool]) -> None:
        for name in [n for n, k in self._kept.items() if stale(k)]:
            self._kept.pop(name).frame.unpersist(blocking=True)

    def __enter__(self) -> ViewKeeper:
        return self

    def __exit__(self, *_) -> None:
        self.release()
