"""Whole runs: resumable mining by batches of tiles, aggregation into tables, filtering."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import replace
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.config import EngineConfig, FilterConfig
from covoxel.functions.names import default_names
from covoxel.operators import filtering
from covoxel.operators.mining import Mined
from covoxel.operators.tiling import Shape
from covoxel.plans import tables
from covoxel.plans.engine import Engine, hold
from covoxel.sinks.store import export_sqlite, write_parquet
from covoxel.sources import checkpoints, objects
from covoxel.sources.checkpoints import DocumentStore, Progress, ResultStore, remaining

Report = Callable[[Progress], None]
#: Tiles of a batch at least, and voxels, stored or not: small tiles come by more, since every batch reads the volume's columns of place.
BATCH_TILES, BATCH_VOXELS = 1024, 1 << 30


def batches(tiles: DataFrame, size: int, unit: tuple[int, int] = (1, 1)) -> Iterator[DataFrame]:
    """Tiles in batches of about `size`, row by row of the grid. What comes to the driver are tile numbers, one pair a tile.

    unit: (tiles down, tiles across) that aren't parted. If it is more than a tile, every batch is a run of neighbouring units of one row of units,
    or several whole rows, so that the box around a batch holds no tile of another one, and a batch has one unit at least.
    """
    spark = tiles.sparkSession
    frame = lambda part: spark.createDataFrame(part, "tile_x int, tile_y int")
    down, across = unit
    place = tiles.select("tile_x", "tile_y", F.expr(f"tile_y div {down}").alias("v"), F.expr(f"tile_x div {across}").alias("u"))
    found = place.orderBy("v", "u", "tile_y", "tile_x").toLocalIterator()
    if unit == (1, 1):
        while part := [(r.tile_x, r.tile_y) for r in islice(found, size)]:
            yield frame(part)
        return
    rows: list[tuple[int, int]] = []  # whole rows of units with the same columns
    below, columns = None, None
    for v, row in groupby(found, lambda r: r.v):
        units = [(u, [(r.tile_x, r.tile_y) for r in of]) for u, of in groupby(row, lambda r: r.u)]
        whole, here = [t for _, of in units for t in of], [u for u, _ in units]
        if rows and (below != v or columns != here or len(rows) + len(whole) > size):
            yield frame(rows)
            rows = []
        if len(whole) <= size and here == list(range(here[0], here[-1] + 1)):
            rows, below, columns = rows + whole, v + 1, here
            continue
        part: list[tuple[int, int]] = []
        last = None
        for u, of in units:
            if part and (u != last + 1 or len(part) + len(of) > size):
                yield frame(part)
                part = []
            part, last = part + of, u
        yield frame(part)
    if rows:
        yield frame(rows)


def batch_size(engine: Engine) -> int:
    """Tiles mined and written at a time, unless a run says otherwise."""
    voxels = engine.shape.z * engine.cfg.tile_y * engine.cfg.tile_x * max(1, engine.channels().count())
    return max(BATCH_TILES, BATCH_VOXELS // voxels)


def run_tiles(engine: Engine, store: ResultStore | DocumentStore, resume: bool = True, batch: int | None = None, report: Report | None = None) -> Mined:
    """Mine the tiles that the store lacks (all, without resume), batch by batch, and return all results. Nothing is computed of
    other tiles; a run that ends early keeps the batches it has written, and what a batch held is dropped after it. Progress is counted while a
    batch is written, so reports need no job of their own. batch: tiles of one; by default by their size."""
    batch = batch or batch_size(engine)
    todo = engine.hold(remaining(engine.tiles(), store.done()) if resume else engine.tiles())
    of, start = engine.n_tiles(), time.monotonic()
    before = of - todo.count() if resume else 0
    done = before
    for part in batches(todo, batch, engine.batch_unit() or (1, 1)):
        now = engine.only(part)
        done += store.write(now.mine())
        now.release()
        if report:
            report(Progress(done, of, before, time.monotonic() - start))
    return store.read()


def published(made: dict[str, DataFrame], path: str | None, sqlite: str | None) -> dict[str, DataFrame]:
    if path:
        write_parquet(made, path)
    if sqlite:
        export_sqlite(made, sqlite)
    return made


def aggregate(engine: Engine, mined: Mined, path: str | None = None, sqlite: str | None = None) -> dict[str, DataFrame]:
    """The result tables, also written as Parquet and as one SQLite file if asked for."""
    return published(engine.result_tables(mined), path, sqlite)


def run_full(engine: Engine, store: ResultStore, path: str | None = None, sqlite: str | None = None, resume: bool = True) -> dict[str, DataFrame]:
    return aggregate(engine, run_tiles(engine, store, resume), path, sqlite)


def aggregate_results(mined: Mined, cfg: EngineConfig, shape: Shape, names: DataFrame | None = None, path: str | None = None, sqlite: str | None = None) -> dict[str, DataFrame]:
    """The result tables of mined tiles alone, without the volume: radii and channels are those of the statistics."""
    radii = [r[0] for r in mined.channel_stats.select("r_um").distinct().collect()]  # a handful
    cfg = replace(cfg, dilate_um=tuple(radii) or cfg.dilate_um)
    if names is None:
        names = default_names(mined.channel_stats.select("channel").distinct())
    return published(tables.result_tables(mined, names, shape, cfg, hold), path, sqlite)


def aggregate_folder(spark: SparkSession, source: str, cfg: EngineConfig, shape: Shape | None = None, names: DataFrame | None = None, path: str | None = None, sqlite: str | None = None) -> dict[str, DataFrame]:
    """The result tables of a folder of tile documents. Without a shape the bounds are those of whole tiles."""
    docs = hold(checkpoints.read_json(spark, source))
    return aggregate_results(checkpoints.flat(docs), cfg, shape or document_shape(docs), names, path, sqlite)


def document_shape(docs: DataFrame) -> Shape:
    """The bounds as whole tiles, where only tile documents are known."""
    z, y, x = (F.max(F.get("tile_shape", F.lit(i))) for i in range(3))
    top = docs.agg(F.max("tile_x"), F.max("tile_y"), z, y, x).first()
    if top[0] is None:
        raise ValueError("no tile results")
    return Shape(top[2], (top[1] + 1) * top[3], (top[0] + 1) * top[4])


def common_radius(stats: DataFrame) -> float:
    """The largest radius, which all tiles must share."""
    per_tile = stats.groupBy("tile_x", "tile_y").agg(F.sort_array(F.collect_set("r_um")).alias("radii")).groupBy("radii").count().collect()
    if not per_tile:
        raise ValueError("no tile results")
    if len(per_tile) > 1:
        raise ValueError("tiles differ in their radii")
    return max(per_tile[0][0])


def filter_results(mined: Mined, cfg: FilterConfig) -> tuple[Mined, DataFrame]:
    """Filtered results and one row of counts. Statistics and counters pass through."""
    r_max = common_radius(mined.channel_stats)
    pairs = filtering.apply(mined.pairs, ["a", "b"], r_max, cfg)
    sets = filtering.apply(mined.sets, ["members"], r_max, cfg)
    return Mined(mined.channel_stats, pairs, sets, mined.summary), filtering.stats(mined.summary, (mined.pairs, mined.sets), (pairs, sets))


def filter_folder(spark: SparkSession, source: str, target: str, cfg: FilterConfig) -> DataFrame:
    """Rewrite a folder of tile documents with the combinations that pass, all else unchanged; one row of counts."""
    docs = hold(checkpoints.read_json(spark, source))
    kept, counts = filter_results(checkpoints.flat(docs), cfg)
    out = checkpoints.with_combinations(docs, kept.pairs, kept.sets)
    if objects.can_open(target):
        checkpoints.write_tiles(out, target, overwrite=True)
    else:
        checkpoints.write_json(out, target)
    return counts


def filter_and_aggregate(engine: Engine, mined: Mined, cfg: FilterConfig, path: str | None = None, sqlite: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """As aggregate(), of filtered results; the engine's true shape gives the bounds of the volume."""
    kept, counts = filter_results(mined, cfg)
    return aggregate(engine, kept, path, sqlite), counts


def filter_and_aggregate_folder(spark: SparkSession, source: str, cfg: EngineConfig, wanted: FilterConfig, shape: Shape | None = None, names: DataFrame | None = None, path: str | None = None, sqlite: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """As aggregate_folder(), of what filter_results() keeps."""
    docs = hold(checkpoints.read_json(spark, source))
    kept, counts = filter_results(checkpoints.flat(docs), wanted)
    return aggregate_results(kept, cfg, shape or document_shape(docs), names, path, sqlite), counts
