"""Command line: python -m covoxel.cli run | aggregate | filter ..."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import MISSING, fields, replace
from functools import partial

from covoxel.config import EngineConfig, FilterConfig, VoxelSize


def listed(kind: type, least: int = 0, most: int | None = None, by: str = ",") -> Callable[[str], tuple]:
    """An argument type: values of a kind, so many of them."""

    def read(text: str) -> tuple:
        try:
            found = tuple(kind(p) for p in text.lower().split(by) if p.strip())
        except ValueError as e:
            raise argparse.ArgumentTypeError(f"{text}: {e}") from None
        if len(found) < least or most is not None and len(found) > most:
            raise argparse.ArgumentTypeError(f"{text}: {least} to {most} values are needed")
        return found

    return read


def tile(text: str) -> tuple[int, int]:
    """"128" or "128x256" (y by x), in either case."""
    sides = listed(int, 1, 2, "x")(text)
    return sides[0], sides[-1]


# Settings whose flag or reading isn't that of their name and default: fixed names of the command line.
FLAGS = {"tile_xy": ("--tile", tile), "channels": ("--channels", listed(int)), "dilate_um": ("--dilate-um", listed(float, 1)), "voxel_size": ("--vox", lambda t: VoxelSize(*listed(float, 3, 3)(t))), "min_obj_vol_um3": ("--min-vol-um3", float), "connectivity": ("--conn", int), "min_marker_vox": ("--min-marker-vox", int), "min_support_pair": ("--min-support-pair", int), "min_support_set": ("--min-support-set", int), "top_k_percent": ("--top-k-percent", float)}
DEFAULTS = {"min_marker_vox": 100, "min_support_pair": 50, "min_support_set": 10}


def add_settings(p: argparse.ArgumentParser, config: type, prefix: str = "") -> None:
    """A flag for every setting: --name, or --no-name where it is on by default."""
    for f in fields(config):
        default = f.default if f.default is not MISSING else f.default_factory()
        flag, kind = FLAGS.get(f.name, (f"--{prefix}{f.name.replace('_', '-')}", type(default)))
        if kind is bool:
            flag = flag if not default else flag.replace("--", "--no-", 1)
            p.add_argument(flag, dest=prefix + f.name, action="store_false" if default else "store_true")
        else:
            p.add_argument(flag, dest=prefix + f.name, type=kind, default=DEFAULTS.get(f.name, default))


def settings(a: argparse.Namespace, config: type, prefix: str = ""):
    return config(**{f.name: getattr(a, prefix + f.name) for f in fields(config)})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="covoxel")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="analyse a volume and write its result tables")
    run.add_argument("--zarr-path", help="a folder of arrays, on any file system that Spark reads")
    run.add_argument("--zarr-url", help="the same on a web server or store; thresholds come from its lowest level")
    run.add_argument("--voxels", help="instead of --zarr-path: Parquet of channel, z, y, x, value; or a folder with level=N below")
    run.add_argument("--remote", help="instead of --zarr-url: a second location, for thresholds from its lowest level")
    run.add_argument("--forbidden-is-absent", action="store_true", help="chunks that a web server refuses (403) aren't stored there; else a refusal ends the run")
    run.add_argument("--checkpoints", help="folder of tile results (default: checkpoints in the output folder)")
    run.add_argument("--tile-documents", action="store_true", help="keep tile results as a folder of documents, tile_XXXX_YYYY.json.gz, instead of Parquet")
    run.add_argument("--no-resume", action="store_true")
    run.add_argument("--batch", type=int, default=1024, help="tiles mined and written at a time")
    stage = sub.add_parser("aggregate", help="write the result tables of a folder of tile documents")
    filt = sub.add_parser("filter", help="keep the combinations of a folder of tile documents that pass")
    filt.add_argument("--target", help="write the filtered documents here")
    for q in (stage, filt):
        q.add_argument("--documents", required=True, help="folder of tile documents")
    for q in (run, stage, filt):
        q.add_argument("--meta", help="OME-XML with channel names and voxel sizes")
        q.add_argument("--output-dir", default="results")
        q.add_argument("--output-name", default="analysis")
        q.add_argument("--sqlite", action="store_true", help="also write one gzip SQLite file")
        add_settings(q, EngineConfig)
    for q in (run, filt):
        add_settings(q, FilterConfig, "filter-")
    run.add_argument("--filter", action="store_true", help="publish only combinations that pass the filter settings")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from covoxel.functions.names import channel_dimension
    from covoxel.plans import runs
    from covoxel.plans.engine import Engine
    from covoxel.sources import objects, omexml, pyramid, zarr
    from covoxel.sources.checkpoints import DocumentStore, ResultStore

    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("covoxel").getOrCreate()
    cfg, names = settings(a, EngineConfig), None
    if a.meta:
        cfg = replace(cfg, voxel_size=omexml.voxel_size(spark, a.meta))
        names = channel_dimension(omexml.channels(spark, a.meta))
    out = f"{a.output_dir.rstrip('/')}/{a.output_name}"
    to = {"path": out, "sqlite": f"{out}.db.gz" if a.sqlite else None}
    if a.command == "aggregate":
        runs.aggregate_folder(spark, a.documents, cfg, names=names, **to)
        return 0
    wanted = settings(a, FilterConfig, "filter-")
    if a.command == "filter":
        if a.target:
            runs.filter_folder(spark, a.documents, a.target, wanted).show()
        else:
            runs.filter_and_aggregate_folder(spark, a.documents, cfg, wanted, names=names, **to)[1].show()
        return 0
    arrays = bool(a.zarr_path or a.zarr_url)
    local, remote = (a.zarr_path, a.zarr_url) if arrays else (a.voxels, a.remote)
    if not local and not remote:
        parser().error("a volume is needed: --zarr-path, --zarr-url, --voxels or --remote")
    absent = (*objects.ABSENT, 403) if a.forbidden_is_absent else objects.ABSENT
    opened = partial(zarr.open_arrays, absent=absent) if arrays else pyramid.open_parquet
    (at, level), (low_at, low) = pyramid.choose_levels(*(opened(spark, p) if p else None for p in (local, remote)))
    if arrays:
        cfg = replace(cfg, channels=cfg.channels or tuple(range(level.channels)))
        voxels, lowres = (zarr.read_array(spark, p, v.key, channels=cfg.channels, absent=absent) for p, v in ((at, level), (low_at, low)))
    else:
        voxels, lowres = (pyramid.read_level(spark, p, v.key) for p, v in ((at, level), (low_at, low)))
    engine = Engine(voxels, level.shape, cfg, lowres=lowres, lowres_shape=low.shape, names=names, block=level.block)
    kept = a.checkpoints or f"{out}/checkpoints"
    store = DocumentStore(spark, kept, cfg, level.shape) if a.tile_documents else ResultStore(spark, kept, cfg)
    mined = runs.run_tiles(engine, store, not a.no_resume, a.batch, print)
    if a.filter:
        runs.filter_and_aggregate(engine, mined, wanted, **to)
    else:
        runs.aggregate(engine, mined, **to)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
