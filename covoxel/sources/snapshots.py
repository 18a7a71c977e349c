"""Tables that several writers change unit by unit, as Parquet folders that snapshots list."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from typing import ClassVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.sources import files


class Conflict(RuntimeError):
    """Another writer has published first."""


class Snapshots:
    """Tables (PARTS: columns by name) whose rows belong to units (KEYS), such as tiles; the table INDEX has every unit that is there.

    A write puts its rows into a folder of its own and then publishes a snapshot: a small file that lists, in order, the folders that count, with
    the fingerprint of the configuration they came from. Snapshots are numbered and created only if their number is free, so of two writers that
    publish at once the second one sees the first one's snapshot and publishes on top of it; neither overwrites the other, and a reader sees all of a
    write or nothing. Only listed folders are read. A unit's rows are those of the last folder that has it in its index. When there are more
    than `merge_at` folders, a write merges them into one; what is listed no longer is removed after `keep` more snapshots, so that readers of
    these can end.
    """

    KEYS: ClassVar[tuple[str, ...]]
    INDEX: ClassVar[str]
    PARTS: ClassVar[dict[str, str]]

    def __init__(self, spark: SparkSession, path: str, cfg: EngineConfig, merge_at: int = 16, keep: int = 2):
        self.spark, self.path, self.cfg, self.merge_at, self.keep = spark, path.rstrip("/"), cfg, merge_at, keep

    def snapshots(self) -> list[int]:
        return sorted(int(m[1]) for f in files.names(self.spark, f"{self.path}/snapshots") if (m := re.fullmatch(r"(\d+)\.json", f)))

    def snapshot(self, number: int | None = None) -> dict:
        """number and folders of the newest snapshot, or of a given one; 0 and none in a new store."""
        every = self.snapshots()
        if not every:
            return {"number": 0, "folders": []}
        found = json.loads(files.text(self.spark, f"{self.path}/snapshots/{every[-1] if number is None else number}.json"))
        if found["fingerprint"] != self.cfg.fingerprint():
            raise ValueError("the results in this folder come from another configuration")
        return found

    def _publish(self, change: Callable[[list[str]], list[str]], after: int | None = None) -> dict:
        """A new snapshot with the newest one's folders changed, again and again until no other writer was faster. after: only if the
        newest is still this one."""
        while True:
            last = self.snapshot()
            if after is not None and last["number"] != after:
                raise Conflict(self.path)
            new = {"number": last["number"] + 1, "fingerprint": self.cfg.fingerprint(), "folders": change(last["folders"])}
            if files.create(self.spark, f"{self.path}/snapshots/{new['number']}.json", json.dumps(new)):
                return new

    def _rows(self, part: str, folders: list[str]) -> DataFrame:
        kept = f"{self.PARTS[part]}, folder string"
        if not folders:
            return self.spark.createDataFrame([], kept)
        return self.spark.read.schema(kept).parquet(*[f"{self.path}/{f}/{part}" for f in folders])

    def _latest(self, folders: list[str]) -> DataFrame:
        """KEYS and the folder that has the unit's rows."""
        order = self.spark.createDataFrame([(f, i) for i, f in enumerate(folders)], "folder string, nth int")  # merge_at rows or a few more
        return self._rows(self.INDEX, folders).join(F.broadcast(order), "folder").groupBy(*self.KEYS).agg(F.max_by("folder", "nth").alias("folder"))

    def frames(self, folders: list[str] | None = None, only: DataFrame | None = None) -> dict[str, DataFrame]:
        """All tables, or of some units (KEYS) alone, as they are now or in the given folders."""
        folders = self.snapshot()["folders"] if folders is None else folders
        out = {part: self._rows(part, folders) for part in self.PARTS}
        if only is not None:
            out = {part: rows.join(only.select(*self.KEYS), list(self.KEYS), "left_semi") for part, rows in out.items()}
        if len(folders) > 1:
            latest = self._latest(folders)
            out = {part: rows.join(latest, [*self.KEYS, "folder"], "left_semi") for part, rows in out.items()}
        return {part: rows.drop("folder") for part, rows in out.items()}

    def index(self) -> DataFrame:
        """The units that are there."""
        return self._rows(self.INDEX, self.snapshot()["folders"]).select(*self.KEYS).distinct()

    def _put(self, frames: dict[str, DataFrame]) -> tuple[str, int]:
        """A folder with these rows, and how many units are in it: counted while they are written."""
        folder, units = f"part-{uuid.uuid4().hex}", Observation()
        for part, kept in self.PARTS.items():
            cols = [F.col(c).cast(t).alias(c) for c, t in (x.split(" ", 1) for x in kept.split(", "))]
            rows = frames[part].select(*cols, F.lit(folder).alias("folder"))
            rows = rows.observe(units, F.count("*").alias("n")) if part == self.INDEX else rows
            rows.write.parquet(f"{self.path}/{folder}/{part}")
        return folder, units.get["n"]

    def add(self, frames: dict[str, DataFrame], after: int | None = None) -> int:
        """Add units, or replace them; how many there were."""
        self.snapshot()
        folder, n = self._put(frames)
        try:
            published = self._publish(lambda folders: [*folders, folder], after)
        except Conflict:
            files.remove(self.spark, f"{self.path}/{folder}")
            raise
        if len(published["folders"]) > self.merge_at:
            self.compact()
        return n

    def compact(self) -> None:
        """Merge all folders into one. Folders that another writer adds meanwhile stay behind it; if another one merges them first, its
        merge counts."""
        old = self.snapshot()["folders"]
        if len(old) < 2:
            return
        merged, _ = self._put(self.frames(old))
        self._publish(lambda now: [merged, *now[len(old) :]] if now[: len(old)] == old else now)
        self._clean()

    def _clean(self) -> None:
        """Remove folders that only snapshots before the last `keep` ones list, and these snapshots. A folder that no snapshot lists may be
        another writer's that isn't published yet, and stays."""
        every = self.snapshots()
        old, new = every[: -self.keep - 1], every[-self.keep - 1 :]
        listed = lambda numbers: {f for n in numbers for f in self.snapshot(n)["folders"]}
        for folder in listed(old) - listed(new):
            files.remove(self.spark, f"{self.path}/{folder}")
        for n in old:
            files.remove(self.spark, f"{self.path}/snapshots/{n}.json")
