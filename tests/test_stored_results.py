"""Arrays read by chunk, tile documents that appear on commit, snapshots of results."""

import collections
import gzip
import json
import os
import threading
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from covoxel import cli
from covoxel.config import EngineConfig, FilterConfig
from covoxel.operators import tiling
from covoxel.operators.mining import Mined
from covoxel.operators.tiling import Shape
from covoxel.plans import runs
from covoxel.plans.engine import Engine
from covoxel.sinks.named_files import write_files
from covoxel.sources import checkpoints, files, objects, zarr
from covoxel.sources.checkpoints import DocumentStore, ResultStore
from tests.test_operators import ARGS, CFG, dense_of, random_volume, write_array


@pytest.fixture
def served(tmp_path):
    """A folder behind a web server that counts what is asked of it and refuses what `refused` says."""
    asked, refused = collections.Counter(), set()

    class Handler(SimpleHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            if any(self.path.endswith(r) for r in refused):
                self.send_error(403)
            else:
                super().do_GET()

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(Handler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked, refused
    server.shutdown()


@pytest.fixture(scope="module")
def mined(spark):
    """An engine over a small volume and its results, mined once, as local frames."""
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    m = e.mine()
    return e, Mined(*[spark.createDataFrame(getattr(m, p).collect(), getattr(m, p).schema) for p in ResultStore.PARTS])


def some(m, condition):
    return Mined(*[getattr(m, p).where(condition) for p in ResultStore.PARTS])


def chunks(asked):
    return {p: n for p, n in asked.items() if not p.endswith(".zarray")}


def volume(seed=0, shape=(1, 2, 4, 64, 64)):
    return np.random.default_rng(seed).integers(0, 3, shape).astype("<u2")


def test_filters_become_chunks(spark, tmp_path, served):
    at, asked, _ = served
    dense = volume()
    write_array(tmp_path / "a", dense, (1, 1, 4, 16, 16))
    voxels = zarr.read_array(spark, f"{at}/a")
    engine = Engine(voxels, Shape(4, 64, 64), EngineConfig(tile_xy=(16, 16), channels=(1,)))
    tile = engine.voxels.where("tile_x = 2 and tile_y = 1").where(F.col("x").between(32, 47) & F.col("y").between(16, 31))
    assert (dense_of(tile, dense)[0, 1] == np.where(np.add.outer(np.arange(64) // 16 * 10, np.arange(64) // 16) == 12, dense[0, 1], 0)).all()
    assert chunks(asked) == {"/a/0.1.0.1.2": 1}  # of 32
    asked.clear()
    assert zarr.read_array(spark, f"{at}/a", channels=(0,), y=(15, 17), x=(60, 64)).count() == np.count_nonzero(dense[0, 0, :, 15:17, 60:64])
    assert chunks(asked) == {"/a/0.0.0.0.3": 1, "/a/0.0.0.1.3": 1}
    asked.clear()
    assert voxels.where("x < 0").count() == voxels.where("x between 5 and 4").count() == 0 and not chunks(asked)


@pytest.mark.parametrize("condition", ["z = 1 and y in (3, 60) and channel <> 1", "x >= 10 and x < 21 and 30 < y", "channel in (0, 5)", "value > 1 and x <=> 7", "y between 10 and 40 and x in (1, 2, 40) and z <= 2", "x > 3 or y > 60", "channel is not null and y <= 0", "x in (1, 1) and x in (1, 2)", "x + 0 = 3 and channel in (1) and channel in (0, 1)"])
def test_filtered_reads_equal_the_whole_filtered(spark, tmp_path, condition):
    dense = volume(1, (1, 2, 3, 62, 45))
    write_array(tmp_path / "a", dense, (1, 2, 2, 10, 16), "zlib", fill=5, without=[(0, 0, 1, 2, 1)])
    read = lambda: zarr.read_array(spark, str(tmp_path / "a"))
    whole = spark.createDataFrame(read().collect(), array_schema := "channel int, z int, y int, x int, value double")
    assert read().schema.simpleString() == whole.schema.simpleString() and array_schema
    assert sorted(map(tuple, read().where(condition).collect())) == sorted(map(tuple, whole.where(condition).collect()))


def test_refusals_end_a_read_unless_asked_otherwise(spark, tmp_path, served, monkeypatch):
    at, asked, refused = served
    dense = volume(2, (1, 1, 2, 8, 8))
    write_array(tmp_path / "a", dense, (1, 1, 2, 4, 4))
    refused.add("0.0.0.1.1")
    with pytest.raises(Exception, match="refused"):
        zarr.read_array(spark, f"{at}/a").count()
    assert asked["/a/0.0.0.1.1"] >= objects.TRIES
    dense[0, 0, :, 4:, 4:] = 0
    assert (dense_of(zarr.read_array(spark, f"{at}/a", absent=(404, 403)), dense) == dense).all()
    with pytest.raises(FileNotFoundError):
        objects.can_open("x") and zarr._read_files(spark, str(tmp_path / "none"), (), None, None, None)


def test_files_of_other_file_systems_are_read_as_before(spark, tmp_path):
    dense = volume(3, (1, 2, 3, 9, 7))
    write_array(tmp_path / "a", dense, (1, 1, 3, 4, 4), "gzip", fill=4, without=[(0, 1, 0, 0, 0)])
    dense[0, 1, :, :4, :4] = 4
    got = zarr._read_files(spark, str(tmp_path / "a"), (1,), None, (0, 6), (1, 7))
    want = np.zeros_like(dense)
    want[0, 1, :, :6, 1:] = dense[0, 1, :, :6, 1:]
    assert (dense_of(got, dense) == want).all()
    write_array(tmp_path / "b", dense, (1, 2, 3, 9, 7), without=[(0, 0, 0, 0, 0)])
    assert zarr._read_files(spark, str(tmp_path / "b"), (), None, None, None).count() == 0


def test_a_run_opens_each_chunk_as_often_whatever_the_batch(spark, tmp_path, served):
    at, asked, _ = served
    dense = np.zeros((1, 2, 2, 8, 8), "<u2")
    dense[0], _ = random_volume(spark, Shape(2, 8, 8), 2)
    write_array(tmp_path / "in" / "0", dense, (1, 1, 2, 4, 4), "zlib")
    write_array(tmp_path / "in" / "1", dense[..., ::2, ::2], (1, 2, 2, 4, 4))
    made = {}
    for batch in ("1", "1000"):
        asked.clear()
        assert cli.main(["run", "--zarr-url", f"{at}/in", "--output-dir", str(tmp_path / "o"), "--output-name", batch, "--batch", batch, *ARGS], spark) == 0
        opened = chunks(asked)
        assert set(opened.values()) == {1} and len(opened) == 2 * 4 + 1, opened
        made[batch] = sorted(map(str, spark.read.parquet(str(tmp_path / "o" / batch / "combinations")).drop("id").collect()))
    assert made["1"] == made["1000"] and made["1"]


def test_batches_are_whole_units(spark):
    grid = tiling.tile_grid(spark, Shape(1, 28, 36), EngineConfig(tile_xy=(4, 4)))  # 7 by 9 tiles
    every = {(x, y) for x in range(9) for y in range(7)}
    for size in (1, 5, 13, 30, 40, 1000):
        for unit in ((2, 3), (1, 4), (7, 1), (3, 9)):
            got = [[tuple(r) for r in b.collect()] for b in runs.batches(grid, size, unit)]
            assert sorted(t for b in got for t in b) == sorted(every)
            for b in got:
                units = {(x // unit[1], y // unit[0]) for x, y in b}
                assert len(b) <= size or len(units) == 1
                us, vs = {u for u, _ in units}, {v for _, v in units}
                assert {(x // unit[1], y // unit[0]) for x, y in every if x // unit[1] in range(min(us), max(us) + 1) and y // unit[0] in range(min(vs), max(vs) + 1)} == units
    left = grid.where("not (tile_x = 4 and tile_y = 0)")
    got = [[tuple(r) for r in b.collect()] for b in runs.batches(left, 100, (1, 1)[:1] + (2,))]
    assert sorted(t for b in got for t in b) == sorted(every - {(4, 0)})


def rows(df):
    return sorted(map(str, df.collect()))


def test_tile_documents_have_their_names_and_resume(spark, tmp_path, mined):
    e, m = mined
    at = str(tmp_path / "docs")
    store = DocumentStore(spark, at, CFG, e.shape)
    assert store.done().count() == 0 and store.read().pairs.count() == 0
    assert store.write(some(m, "tile_x = 0 or tile_y = 0")) == 3
    assert sorted(os.listdir(at)) == ["tile_0000_0000.json.gz", "tile_0000_0001.json.gz", "tile_0001_0000.json.gz"]
    assert sorted(map(tuple, store.done().collect())) == [(0, 0), (0, 1), (1, 0)]
    seen = []
    got = runs.run_tiles(e, store, batch=1, report=lambda p: seen.append((p.done, p.of)))
    assert seen == [(4, 4)] and store.done().count() == 4
    cols = [c for c in m.sets.columns if c != "r_idx"]
    assert rows(got.sets.select(cols)) == rows(m.sets.select(cols))
    assert store.write(some(m, "tile_x = 1 and tile_y = 1")) == 1 and store.done().count() == 4
    counts = runs.filter_folder(spark, at, str(tmp_path / "kept"), FilterConfig(min_inter_vox=4)).first()
    assert checkpoints.completed(spark, str(tmp_path / "kept")).count() == 4 and counts.pairs_after > 0
    assert checkpoints.broken_files(spark, at).count() == 0
    whole = (tmp_path / "docs" / "tile_0000_0000.json.gz").read_bytes()
    (tmp_path / "docs" / "tile_0000_0000.json.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "docs" / "tile_0009_0009.json.gz").write_bytes(gzip.compress(b'{"a": 1}'))
    assert sorted(r.path[-22:] for r in checkpoints.broken_files(spark, at).collect()) == ["tile_0000_0000.json.gz", "tile_0009_0009.json.gz"]


def test_files_appear_on_commit_alone(spark, tmp_path):
    at = str(tmp_path / "out")
    some = spark.range(8).repartition(4).select(F.format_string("n%02d", "id").alias("name"), F.col("id").cast("string").cast("binary").alias("content"))
    failing = some.withColumn("content", F.when(F.col("name") == "n05", F.raise_error(F.lit("broken task"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken task"):
        write_files(failing, at)
    seen = lambda: sorted(f for f in (os.listdir(at) if os.path.exists(at) else ()) if f[0] != "_")
    assert seen() == []  # what a task that still ran has left is hidden
    write_files(some, at)
    assert seen() == [f"n{i:02d}" for i in range(8)] and (tmp_path / "out" / "n03").read_bytes() == b"3"
    with pytest.raises(Exception, match="broken task"):
        write_files(failing, at, overwrite=True)
    assert len(seen()) == 8
    write_files(some.where("name = 'n01'").withColumn("content", F.lit(b"new")), at, overwrite=True)
    assert seen() == ["n01"] and (tmp_path / "out" / "n01").read_bytes() == b"new"
    with pytest.raises(Exception, match="no name"):
        write_files(some.withColumn("name", F.lit("../x")), at)
    with pytest.raises(ValueError, match="can't write"):
        write_files(some, "viewfs://x/y")


def test_writers_at_once_keep_both_their_tiles(spark, tmp_path, mined):
    e, m = mined
    one, two = (ResultStore(spark, str(tmp_path / "s"), CFG) for _ in range(2))
    started = one.snapshot()
    real = one._put

    def late(frames):
        out = real(frames)
        two.write(some(m, "tile_x = 1"))  # another run publishes first
        return out

    one._put = late
    assert one.write(some(m, "tile_x = 0")) == 2
    assert started["number"] == 0 and one.snapshot()["number"] == 2 and one.done().count() == 4
    cols = two.read().pairs.columns
    assert rows(two.read().pairs) == rows(m.pairs.select(cols))
    assert not files.create(spark, str(tmp_path / "s" / "snapshots" / "2.json"), "x") and json.loads(files.text(spark, str(tmp_path / "s" / "snapshots" / "2.json")))["number"] == 2


def test_threads_create_one_file(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda i=i: files.create(spark, str(tmp_path / "f" / "1.json"), str(i)) and won.append(i)) for i in range(16)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and (tmp_path / "f" / "1.json").read_text() == str(won[0]) and os.listdir(tmp_path / "f") == ["1.json"]


def test_merged_folders_are_removed_and_readers_end(spark, tmp_path, mined):
    _, m = mined
    store = ResultStore(spark, str(tmp_path / "s"), CFG, merge_at=2, keep=1)
    for k in range(5):
        store.write(some(m, f"tile_x = {k % 2} and tile_y = {k // 2 % 2}"))
        if k == 3:
            held = store.read()
            want = rows(held.pairs)
        assert len(store.snapshot()["folders"]) <= 2
    assert rows(held.pairs) == want  # still there
    assert store.done().count() == 4 and rows(store.read().pairs) == rows(m.pairs.select(store.read().pairs.columns))
    store.write(some(m, "tile_x = 0 and tile_y = 0"))
    store.compact()
    left = {f for n in store.snapshots() for f in store.snapshot(n)["folders"]}
    assert len(store.snapshots()) == 2 and {f for f in os.listdir(tmp_path / "s") if f.startswith("part-")} == left
    plan = store.read().pairs._jdf.queryExecution().executedPlan().toString()
    assert len(store.snapshot()["folders"]) == 1 and "1 paths" in plan


def test_reports_need_no_jobs(spark, tmp_path, monkeypatch):
    """Progress comes from what the writes observe: the store is asked once, before the first batch."""
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), EngineConfig(**{**CFG.__dict__, "max_set_size": 2, "dilate_um": (0,)}))
    store, asked, seen = ResultStore(spark, str(tmp_path / "s"), e.cfg), [], []
    monkeypatch.setattr(store, "done", lambda real=store.done: asked.append(1) or real())
    runs.run_tiles(e, store, batch=2, report=lambda p: seen.append((p.since, p.done, p.of)))
    assert len(asked) == 1 and seen == [(0, 2, 4), (0, 4, 4)]


def test_updated_roll_ups_equal_whole_ones(spark, tmp_path, mined):
    """Tiles change to other results, to fewer and to none; two writers at once."""
    from covoxel.plans import tables
    from covoxel.plans.incremental import RollupStore

    cfg = EngineConfig(**{**CFG.__dict__, "hierarchy_levels": 3})
    e, m = mined
    first = {p: getattr(m, p).collect() for p in ResultStore.PARTS} | {"schema": {p: getattr(m, p).schema for p in ResultStore.PARTS}}
    # The same results at other tiles, so that there are 5 x 3 of them; and a second version, in which they stand elsewhere.
    place = lambda x, y, k: (x, y) if k == 0 else (4 - x, 2 - y)
    copies = [(x, y) for x in range(5) for y in range(3)]
    versions = [{p: [r.__class__(**{**r.asDict(), "tile_x": u, "tile_y": w}) for x, y in copies for u, w in [place(x, y, k)] for r in first[p] if (r.tile_x, r.tile_y) == (x % 2, y % 2)] for p in ResultStore.PARTS} | {"schema": first["schema"]} for k in (0, 1)]
    frame = lambda part, rows: spark.createDataFrame(rows, versions[0]["schema"][part])
    rng = np.random.default_rng(5)
    tiles = [(r.tile_x, r.tile_y) for r in versions[0]["summary"]]
    store, current = RollupStore(spark, str(tmp_path / "r"), cfg, merge_at=2), {}
    for step in range(3):
        changed = tiles if step == 0 else [tiles[i] for i in rng.choice(len(tiles), 4, replace=False)]
        of = {t: int(rng.integers(0, 2)) if step < 2 else None for t in changed}  # at last to nothing
        current |= of
        pick = lambda part, some: frame(part, [r for k, v in enumerate(versions) for r in v[part] if some.get((r.tile_x, r.tile_y), -1) == k])
        gone = frame("summary", [r for r in versions[0]["summary"] if (r.tile_x, r.tile_y) in of])
        n = store.update(Mined(pick("channel_stats", of), pick("pairs", of), pick("sets", of), gone))
        assert n < len(tiles) + 12 if step == 0 else n <= 4 * cfg.hierarchy_levels
        whole = tables.roll_up(Mined(*[pick(p, current) for p in ("channel_stats", "pairs", "sets")], gone), cfg)
        for a, b in zip(store.read(), whole):
            cols = sorted(set(b.columns) - {"least_vox"})
            shown = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in b.select(cols).dtypes]
            assert rows(a.select(*shown)) == rows(b.select(*shown)) and a.count()


def test_an_update_begins_again_after_another(spark, tmp_path):
    from covoxel.plans.incremental import RollupStore

    cfg = EngineConfig(**{**CFG.__dict__, "hierarchy_levels": 2})

    def one(x):
        stats = spark.createDataFrame([(x, 0, 1, 0.0, 5, 2.0)], "tile_x int, tile_y int, channel int, r_um double, voxel_count long, sum_intensity double")
        pairs = spark.createDataFrame([], "tile_x int, tile_y int, r_um double, a int, b int, a_vox long, b_vox long, inter_vox long, union_vox long")
        sets = spark.createDataFrame([], "tile_x int, tile_y int, r_um double, members array<int>, k int, inter_vox long, union_vox long, member_vox array<long>")
        return Mined(stats, pairs, sets, stats.select("tile_x", "tile_y"))

    first, second = (RollupStore(spark, str(tmp_path / "r"), cfg) for _ in range(2))
    real, tried = first._put, []

    def late(frames):
        out = real(frames)
        if not tried:
            second.update(one(1))
        tried.append(1)
        return out

    first._put = late
    first.update(one(0))
    top = [(r.hierarchy_level, r.region_x, r.voxel_count) for r in first.read()[0].collect()]
    assert sorted(top) == [(0, 0, 5), (0, 1, 5), (1, 0, 10)] and len(tried) == 2
    assert len({f for f in os.listdir(tmp_path / "r") if f.startswith("part-")}) == 2
