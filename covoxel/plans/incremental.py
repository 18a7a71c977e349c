"""A roll-up that is kept, and brought up to date where tiles have changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covoxel.operators import rollup
from covoxel.operators.mining import Mined
from covoxel.plans.engine import hold, let_go
from covoxel.sources.snapshots import Conflict, Snapshots

REGION = ", ".join(f"{c} int" for c in rollup.REGION)


class RollupStore(Snapshots):
    """The sums of every region and level. Its units are regions: a changed tile touches one a level.

    A level's region is the sum of its four children, so update() computes the touched regions of level 0 from their tiles, and those of
    each further level from the touched children and their stored siblings, which are found by region; all else stays as it is. Sums are never
    taken back, so results don't drift, however often a tile changes.
    """

    KEYS, INDEX = tuple(rollup.REGION), "regions"
    PARTS = {
        "channels": f"{REGION}, channel int, r_um double, voxel_count long, sum_intensity double",
        "pairs": f"{REGION}, a int, b int, r_um double, a_vox long, b_vox long, inter_vox long, union_vox long",
        "sets": f"{REGION}, members array<int>, k int, r_um double, inter_vox long, union_vox long, member_vox array<long>",
        "regions": REGION,
    }
    SUMS = {"channels": ("voxel_count", "sum_intensity"), "pairs": ("a_vox", "b_vox", "inter_vox", "union_vox"), "sets": ("inter_vox", "union_vox")}

    def _sum(self, part: str, rows: DataFrame) -> DataFrame:
        """Rows of the same region and combination as one."""
        names = [c.split(" ")[0] for c in self.PARTS[part].split(", ")]
        sums = [F.sum(c).alias(c) for c in self.SUMS[part]]
        if part == "sets":  # place by place
            most = max(self.cfg.max_set_size, 3)
            sums += [F.slice(F.array(*[F.sum(F.coalesce(F.get("member_vox", F.lit(i)), F.lit(0))) for i in range(most)]), F.lit(1), F.col("k")).alias("member_vox")]
        by = [c for c in names if c not in self.SUMS[part] and c != "member_vox"]
        return rows.groupBy(*by).agg(*sums).select(*names)

    def update(self, m: Mined) -> int:
        """Take in the results of tiles that are new or have changed: m has all rows of these tiles and no others; its summary says which they are.
        The number of regions that were touched. If another writer publishes meanwhile, it begins again on top of that."""
        while True:
            try:
                return self._update(m)
            except Conflict:
                continue

    def _update(self, m: Mined) -> int:
        base = self.snapshot()
        at = {"hierarchy_level": F.lit(0), "region_x": F.col("tile_x"), "region_y": F.col("tile_y")}
        now = {"channels": m.channel_stats, "pairs": m.pairs, "sets": m.sets}
        now = {part: self._sum(part, rows.withColumns(at)) for part, rows in now.items()} | {"regions": m.summary.select("tile_x", "tile_y").distinct().select(*[c.alias(n) for n, c in at.items()])}
        held, made = [], []
        for level in range(self.cfg.hierarchy_levels):
            if level:
                parents = now["regions"].select(*[F.call_function("shiftright", F.col(c), F.lit(1)).alias(c) for c in ("region_x", "region_y")]).distinct()
                double = lambda c: F.call_function("shiftleft", F.col(c), F.lit(1))
                child = F.explode(F.array(*[F.struct((double("region_x") + i).alias("region_x"), (double("region_y") + j).alias("region_y")) for i in (0, 1) for j in (0, 1)])).alias("c")
                children = parents.select(child).select(F.lit(level - 1).alias("hierarchy_level"), "c.region_x", "c.region_y")
                others = self.frames(base["folders"], children.join(now["regions"], list(self.KEYS), "left_anti"))
                up = {"hierarchy_level": F.lit(level), "region_x": F.call_function("shiftright", F.col("region_x"), F.lit(1)), "region_y": F.call_function("shiftright", F.col("region_y"), F.lit(1))}
                every = {part: rows.unionByName(others[part].where(F.col("hierarchy_level") == level - 1)) for part, rows in now.items() if part != "regions"}
                now = {part: self._sum(part, rows.withColumns(up)) for part, rows in every.items()} | {"regions": parents.select(F.lit(level).alias("hierarchy_level"), "region_x", "region_y")}
            now = {part: hold(rows) for part, rows in now.items()}
            held += now.values()
            made.append(now)
        frames = made[0]
        for more in made[1:]:
            frames = {part: rows.unionByName(more[part]) for part, rows in frames.items()}
        try:
            return self.add(frames, after=base["number"])
        finally:
            for df in held:
                let_go(df)

    def read(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Channels, pairs and sets as tables.roll_up() gives them."""
        found = self.frames()
        return rollup.channel_measures(found["channels"]), rollup.pair_measures(found["pairs"]), rollup.set_measures(found["sets"])
