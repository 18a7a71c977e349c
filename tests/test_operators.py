"""Hand-made cases and brute force for the engine's stages."""

import bz2
import gzip
import json
import math
import sqlite3
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from covoxel import cli
from covoxel.config import EngineConfig, FilterConfig, VoxelSize
from covoxel.functions import names as fn
from covoxel.operators import components, filtering, mining, proximity, thresholds, tiling
from covoxel.operators.tiling import Shape
from covoxel.plans import runs
from covoxel.plans.engine import Engine
from covoxel.sinks.store import export_sqlite, import_sqlite, read_parquet, write_parquet
from covoxel.sources import checkpoints, omexml, pyramid, zarr
from covoxel.sources.checkpoints import ResultStore, remaining
from covoxel.streaming.tiles import VOXELS, mine_stream, stream_voxels

CFG = EngineConfig(tile_xy=(4, 4), voxel_size=VoxelSize(1, 1, 2), min_obj_vol_um3=2, dilate_um=(0, 1, 2), min_marker_vox=1, min_support_pair=1, min_support_set=1, hierarchy_levels=2)


def vox(spark, rows):
    return spark.createDataFrame(rows, "channel int, z int, y int, x int, value double")


def random_volume(spark, shape=Shape(3, 6, 7), channels=3, seed=1):
    rng = np.random.default_rng(seed)
    dense = rng.integers(0, 60, (channels, shape.z, shape.y, shape.x)) * (rng.random((channels, shape.z, shape.y, shape.x)) < 0.5)
    rows = [(*map(int, i), float(dense[i])) for i in zip(*np.nonzero(dense))]
    return dense, vox(spark, rows)


def test_config_is_validated():
    for bad in ({"connectivity": 18}, {"dilate_um": ()}, {"dilate_um": (1, 1)}, {"dilate_um": (-1,)}, {"alpha": 0}, {"tile_xy": (0, 1)}, {"channels": (1, 1)}):
        with pytest.raises(ValueError):
            EngineConfig(**bad)
    assert EngineConfig().min_voxels == 183
    assert abs(EngineConfig().z_alpha - 0.25334710) < 1e-8
    assert EngineConfig.at({1.0: 5}, 2.0) == 0
    assert EngineConfig().fingerprint() != CFG.fingerprint()


def test_grid_and_batches(spark):
    grid = tiling.tile_grid(spark, Shape(2, 5, 9), CFG).collect()
    assert [(r.tile_x, r.tile_y) for r in grid] == [(x, y) for y in range(2) for x in range(3)]
    assert grid[-1].x1 == 12 and grid[0].total_voxels == 32
    parts = [[tuple(r) for r in b.collect()] for b in runs.batches(tiling.tile_grid(spark, Shape(2, 5, 9), CFG), 4)]
    assert parts == [[(0, 0), (1, 0), (2, 0), (0, 1)], [(1, 1), (2, 1)]]


def naive_labels(points, connectivity):
    near = [o for o in product((-1, 0, 1), repeat=3) if o != (0, 0, 0) and (connectivity == 26 or sum(map(abs, o)) == 1)]
    left, out = set(points), {}
    while left:
        todo = [left.pop()]
        seen = set(todo)
        while todo:
            p = todo.pop()
            for o in near:
                q = tuple(a + b for a, b in zip(p, o))
                if q in left:
                    left.remove(q)
                    seen.add(q)
                    todo.append(q)
        for p in seen:
            out[p] = frozenset(seen)
    return out


@settings(max_examples=40, deadline=None)
@given(st.sets(st.tuples(*[st.integers(0, 4)] * 3), max_size=60), st.sampled_from([6, 26]))
def test_labels_match_flood_fill(points, connectivity):
    points = sorted(points)
    z, y, x = (np.array([p[i] for p in points], dtype=np.int64) for i in range(3))
    got = components.label(z, y, x, connectivity)
    want = naive_labels(points, connectivity)
    groups = {}
    for p, g in zip(points, got):
        groups.setdefault(g, set()).add(p)
    assert {frozenset(g) for g in groups.values()} == set(want.values())


def test_components_end_at_tiles_and_sizes_count_inclusively(spark):
    rows = [(0, 0, 0, 3, 9.0), (0, 0, 0, 4, 9.0), (0, 0, 0, 5, 9.0), (0, 1, 2, 0, 9.0), (0, 0, 3, 1, 9.0)]
    fg = tiling.with_tiles(vox(spark, rows), CFG)
    got = {(r.x, r.y): r.size for r in components.components(fg, CFG).collect()}
    assert got == {(3, 0): 1, (4, 0): 2, (5, 0): 2, (0, 2): 2, (1, 3): 2}
    six = EngineConfig(**{**CFG.__dict__, "connectivity": 6})
    assert {r.size for r in components.components(fg, six).where("x < 2").collect()} == {1}
    one = EngineConfig(**{**CFG.__dict__, "min_obj_vol_um3": 4.0})
    assert components.keep_large(components.components(fg, one), one).count() == 4
    assert components.components(fg.limit(0), CFG).count() == 0


def test_thresholds_match_dense_numpy(spark):
    shape = Shape(3, 6, 7)
    dense, v = random_volume(spark, shape)
    tiles = tiling.with_tiles(v, CFG)
    g = thresholds.global_thresholds(tiles, shape, CFG)
    t_global = {r.channel: r.t_global for r in g.collect()}
    got = {(r.channel, r.tile_x, r.tile_y): r for r in thresholds.tile_thresholds(tiles, g, shape, CFG).collect()}
    for c in range(3):
        m = dense[c].max(axis=0).astype(float)
        bg = m[m <= np.quantile(m, CFG.trim_q)]
        mad = np.median(np.abs(bg - np.median(bg))) + 1e-6
        assert t_global[c] == pytest.approx(np.median(bg) + CFG.z_alpha * 1.4826 * mad)
        for ty, tx in product(range(2), range(2)):
            t = m[ty * 4 : ty * 4 + 4, tx * 4 : tx * 4 + 4].ravel()
            b = t[t <= np.quantile(t, CFG.trim_q)]
            a = max(CFG.alpha, 1 / max(1, len(b)))
            r = got[c, tx, ty]
            assert (r.alpha_eff, r.q_tile) == (a, pytest.approx(np.quantile(b, 1 - a)))
            assert r.t_final == max(r.t_global, r.q_tile)


def test_small_tiles_have_their_own_level(spark):
    cfg = EngineConfig(**{**CFG.__dict__, "tile_xy": (1, 1)})
    v = tiling.with_tiles(vox(spark, [(0, 0, 0, 0, 5.0), (0, 0, 0, 1, 7.0)]), cfg)
    g = spark.createDataFrame([(0, -1.0)], "channel int, t_global double")
    out = {r.tile_x: r for r in thresholds.tile_thresholds(v, g, Shape(1, 1, 2), cfg).collect()}
    assert out[0].alpha_eff == 1.0 and out[0].q_tile == 5.0 and out[1].t_final == 7.0
    assert thresholds.foreground(v, thresholds.tile_thresholds(v, g, Shape(1, 1, 2), cfg)).count() == 0  # strictly above


def test_proximity_matches_brute_force(spark):
    shape = Shape(3, 6, 7)
    dense, v = random_volume(spark, shape, 2, 5)
    fg = tiling.with_tiles(v.where("value > 45"), CFG)
    got = {(r.channel, r.z, r.y, r.x): r.min_d2 for r in proximity.proximity(fg, shape.z, shape.y, shape.x, CFG).collect()}
    want = {}
    on = [(r.channel, r.z, r.y, r.x) for r in fg.collect()]
    for c, z, y, x in product(range(2), range(3), range(6), range(7)):
        d = [4 * (z - b) ** 2 + (y - e) ** 2 + (x - f) ** 2 for a, b, e, f in on if a == c and e // 4 == y // 4 and f // 4 == x // 4]
        if d and min(d) <= 4:
            want[c, z, y, x] = min(d)
    assert got == want
    counts = {r.r_idx: r["count"] for r in proximity.masks(proximity.proximity(fg, 3, 6, 7, CFG), CFG).groupBy("r_idx").count().collect()}
    assert counts[0] == len(on) and counts[0] <= counts[1] <= counts[2]
    plan = proximity.proximity(fg, 3, 6, 7, CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def frequent(spark, pairs):
    return spark.createDataFrame([(0, 0, a, b, [a, b]) for a, b in pairs], "tile_x int, tile_y int, a int, b int, members array<int>")


def test_candidates_are_cliques_with_gates(spark):
    square = [(0, 1), (0, 2), (1, 2), (1, 3), (2, 3)]
    got = [tuple(r.members) for r in mining.set_candidates(frequent(spark, square), 4).collect()]
    assert sorted(got) == [(0, 1, 2), (1, 2, 3)]
    assert mining.set_candidates(frequent(spark, square), 2).count() == 0
    full = [(a, b) for a in range(6) for b in range(a + 1, 6)]
    sizes = mining.set_candidates(frequent(spark, full), 5).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in sizes} == {k: math.comb(6, k) for k in (3, 4, 5)}
    wide = [(a, b) for a in range(6) for b in range(a + 1, 6)] + [(10 + 2 * i, 11 + 2 * i) for i in range(25)]
    assert {r.k for r in mining.set_candidates(frequent(spark, wide), 4).collect()} == {3}  # over 50 channels
    many = [(a, b) for a in range(101) for b in range(a + 1, 101)]
    assert mining.set_candidates(frequent(spark, many), 3).count() == 0  # over 5,000 pairs
    some = [(a, b) for a in range(45) for b in range(a + 1, 45)]
    capped = mining.set_candidates(frequent(spark, some), 3).collect()
    assert len(capped) == 10_000 and max(tuple(r.members) for r in capped) == sorted(tuple(c) for c in _triples(45))[9_999]


def _triples(n):
    return [(a, b, c) for a in range(n) for b in range(a + 1, n) for c in range(b + 1, n)]


def test_more_channels_than_a_word(spark):
    rows = [(0, 0, 0, c, 0, 0, x) for c in (0, 61, 62, 130) for x in range(c % 7 + 1)]
    masked = spark.createDataFrame([(*r, r[3]) for r in rows], "tile_x int, tile_y int, r_idx int, channel int, z int, y int, x int, pos int")
    h = mining.signatures(masked, 131)
    assert [c for c in h.columns if c.startswith("w")] == ["w0", "w1", "w2"]
    counts = masked.groupBy("tile_x", "tile_y", "r_idx", "channel", "pos").count().withColumnRenamed("count", "voxel_count")
    got = {(r.a, r.b): (r.inter_vox, r.union_vox) for r in mining.count_overlaps(mining.active_pairs(counts), h).collect()}
    n = {c: c % 7 + 1 for c in (0, 61, 62, 130)}
    assert got == {(a, b): (min(n[a], n[b]), max(n[a], n[b])) for a in n for b in n if a < b}


def test_mining_invariants(spark):
    _, v = random_volume(spark, seed=3)
    m = Engine(v, Shape(3, 6, 7), CFG).mine()
    pairs, sets = m.pairs.collect(), m.sets.collect()
    assert pairs and sets
    for r in pairs:
        assert 0 < r.inter_vox <= min(r.a_vox, r.b_vox) <= max(r.a_vox, r.b_vox) <= r.union_vox
        assert 0 <= r.iou <= r.overlap_coeff <= 1
    inter = {(r.tile_x, r.tile_y, r.r_idx, r.a, r.b): r.inter_vox for r in pairs}
    for r in sets:
        a, b, c = r.members[:3]
        assert r.inter_vox <= inter[r.tile_x, r.tile_y, r.r_idx, a, b]
    for (tx, ty, i, a, b), n in inter.items():
        assert n <= inter.get((tx, ty, i + 1, a, b), n)
    channels, up, _ = Engine(v, Shape(3, 6, 7), CFG).rollup()
    for rows, cols in ((channels, ["voxel_count"]), (up, ["inter_vox", "union_vox"])):
        sums = [tuple(r) for r in rows.groupBy("hierarchy_level").agg({c: "sum" for c in cols}).drop("hierarchy_level").collect()]
        assert len(set(sums)) == 1


def test_intensity_in_a_dilated_smallest_mask(spark):
    cfg = EngineConfig(**{**CFG.__dict__, "dilate_um": (1, 2)})
    _, v = random_volume(spark, seed=4)
    e = Engine(v, Shape(3, 6, 7), cfg)
    near = {(r.channel, r.z, r.y, r.x) for r in e.proximity().where("min_d2 <= 1").collect()}
    want = sum(r.value for r in v.collect() if (r.channel, r.z, r.y, r.x) in near)
    stats = e.mine().channel_stats
    assert {r.s for r in stats.groupBy("r_idx").agg(F.sum("sum_intensity").alias("s")).collect()} == {want}


def test_empty_volume(spark):
    e = Engine(vox(spark, []), Shape(2, 4, 4), EngineConfig(**{**CFG.__dict__, "channels": (0, 1)}))
    m = e.mine()
    assert m.pairs.count() == 0 and m.sets.count() == 0 and m.channel_stats.count() == 6
    assert [tuple(r) for r in m.summary.collect()] == [(0, 0, 0, 0)]


def test_stop_needs_nothing_eligible(spark):
    spine = spark.createDataFrame([(0, 0, i) for i in range(3)], "tile_x int, tile_y int, r_idx int")
    eligible = spine.where("r_idx <> 1")
    assert [r.r_idx for r in mining.sweep_alive(spine, eligible, True).collect()] == [2]
    assert sorted(r.r_idx for r in mining.sweep_alive(spine, eligible, False).collect()) == [0, 2]


def pair_frame(spark, rows):
    return spark.createDataFrame(rows, "tile_x int, tile_y int, r_um double, a int, b int, inter_vox long, overlap_coeff double")


def test_filter_rules(spark):
    rows = [(t, 0, 2.0, 0, 1, 10, 0.5) for t in range(4)] + [(0, 0, 1.0, 0, 1, 1, 0.1), (0, 0, 2.0, 0, 2, 10, 0.0), (1, 0, 2.0, 0, 2, 10, 0.9), (2, 0, 2.0, 1, 2, 1, 0.9)]
    p = pair_frame(spark, rows)
    cfg = FilterConfig(min_inter_vox=5, min_tiles_present=2, top_k_percent=0.5)
    key = ["a", "b"]
    assert {(r.a, r.b): r.n_tiles for r in filtering.valid_keys(p, key, 2.0, cfg).collect()} == {(0, 1): 4, (0, 2): 2}
    top = sorted((r.a, r.b, r.tile_x) for r in filtering.top_tiles(p, key, 2.0, cfg).collect())
    assert top == [(0, 1, 0), (0, 1, 1), (0, 2, 1)]  # ties by tile; coefficient 0 isn't ranked
    kept = sorted((r.a, r.b, r.tile_x, r.r_um) for r in filtering.apply(p, key, 2.0, cfg).collect())
    assert kept == [(0, 1, 0, 1.0), (0, 1, 0, 2.0), (0, 1, 1, 2.0), (0, 2, 1, 2.0)]
    assert filtering.apply(p, key, 2.0, FilterConfig(min_set_size=3)).count() == 0
    all_rows = FilterConfig(min_inter_vox=5, filter_by_max_dilation=False)
    assert filtering.apply(p, key, 2.0, all_rows).count() == 7
    no_top = FilterConfig(min_inter_vox=5)
    once = filtering.apply(p, key, 2.0, no_top)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, filtering.apply(once, key, 2.0, no_top).collect()))


def test_names(spark):
    dim = fn.channel_dimension(spark.createDataFrame([(0, "A"), (1, "B"), (3, "A"), (4, "x Do Not Use")], "channel int, name string"))
    assert sorted(map(tuple, dim.collect())) == [(0, "A"), (1, "B")]
    rows = spark.createDataFrame([([7, 0],), ([1, 0],)], "members array<int>")
    assert sorted(r.channels for r in fn.channels_key(rows, dim).collect()) == ["A|B", "A|ch7"]
    combos = spark.createDataFrame([("A|B",), ("A|A",)], "channels string")
    assert [r.channels for r in fn.without_self_pairs(combos).collect()] == ["A|B"]


def test_checkpoint_documents_round_trip(spark, tmp_path):
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    m = e.mine()
    docs = checkpoints.documents(m, e.tiles(), CFG, 3)
    checkpoints.write_json(docs, str(tmp_path / "docs"))
    back = checkpoints.flat(checkpoints.read_json(spark, str(tmp_path / "docs")))
    cols = ["tile_x", "tile_y", "r_um", "k", "members", "member_vox", "inter_vox", "union_vox"]
    assert sorted(map(tuple, back.sets.select(cols).collect()), key=str) == sorted(map(tuple, m.sets.select(cols).collect()), key=str)
    assert back.channel_stats.count() == m.channel_stats.count()


def test_foreign_files_are_survived(spark, tmp_path):
    doc = {"tile_x": 1, "tile_y": 2, "radii_um": [0.0], "marker_vox": {"0.0": {"3": 5}}, "channel_stats": [], "pairs": [], "sets": []}
    for name in ("tile_0001_0002.json.gz", "tile_0003_0004.json.gz", "tile_x.json.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(json.dumps({**doc, "tile_x": int(name[5:9])} if name[5].isdigit() else "broken"))
    whole = (tmp_path / "tile_0003_0004.json.gz").read_bytes()
    (tmp_path / "tile_0005_0006.json.gz").write_bytes(whole[: len(whole) // 2])
    assert sorted(r.tile_x for r in checkpoints.read_json(spark, str(tmp_path)).collect()) == [1, 3]
    done = checkpoints.completed(spark, str(tmp_path))
    assert sorted(map(tuple, done.collect())) == [(1, 2), (3, 4), (5, 6)]
    assert tuple(checkpoints.stats(done).first()) == (3, 1, 5, 2, 6)
    assert tuple(checkpoints.stats(done.limit(0)).first()) == (0, None, None, None, None)
    assert checkpoints.read_json(spark, str(tmp_path / "none")).count() == 0


def test_resume_equals_a_full_run_and_checks_the_configuration(spark, tmp_path):
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    want = sorted(map(str, e.mine().pairs.drop("r_idx").collect()))
    store = ResultStore(spark, str(tmp_path / "store"), CFG)
    store.write(e.mine(e.tiles().where("tile_x = 0")))
    assert store.done().count() == 2
    got = runs.run_tiles(e, store)
    cols = e.mine().pairs.drop("r_idx").columns
    assert sorted(map(str, got.pairs.select(cols).collect())) == want
    assert store.done().count() == 4
    with pytest.raises(ValueError, match="configuration"):
        ResultStore(spark, str(tmp_path / "store"), EngineConfig()).done()


def test_tables_round_trip(spark, tmp_path):
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    made = e.result_tables()
    write_parquet(made, str(tmp_path / "p"))
    export_sqlite(made, str(tmp_path / "t.db.gz"))
    back, files = import_sqlite(spark, str(tmp_path / "t.db.gz")), read_parquet(spark, str(tmp_path / "p"))
    for name, df in made.items():
        assert back[name].count() == df.count() == files[name].count()
    ids = [r.id for r in made["combinations"].select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert sorted(ids) == sorted(r.combination_id for r in made["tiles"].collect())
    (tmp_path / "t.db").write_bytes(gzip.decompress((tmp_path / "t.db.gz").read_bytes()))
    assert sqlite3.connect(tmp_path / "t.db").execute("SELECT count(*) FROM combinations").fetchone()[0] == len(ids)
    most = e.mine().pairs.agg({"inter_vox": "max"}).first()[0]
    tables, counts = runs.filter_and_aggregate(e, e.mine(), FilterConfig(min_inter_vox=most))
    assert tables["combinations"].count() < len(ids) and counts.first().pairs_after < counts.first().pairs_before


def test_level_choice():
    def p(where, *keys):
        return pyramid.Pyramid(where, tuple(pyramid.Level(k, Shape(1, 64 >> int(k or 0), 64)) if k.isdigit() else pyramid.Level(k, Shape(1, 64, 64)) for k in keys))

    one, many, rone, rmany = p("l", "root"), p("l", "0", "1", "2"), p("r", "root"), p("r", "0", "1")
    pick = lambda a, b: tuple((w, v.key) for w, v in pyramid.choose_levels(a, b))
    assert pick(many, rmany) == (("l", "0"), ("l", "2"))
    assert pick(one, rmany) == (("l", "root"), ("r", "1"))
    assert pick(one, rone) == (("l", "root"), ("r", "root"))
    assert pick(one, None) == (("l", "root"), ("l", "root"))
    assert pick(None, rmany) == (("r", "0"), ("r", "1"))
    with pytest.raises(ValueError):
        pyramid.choose_levels(None, None)
    assert pyramid.is_remote("s3://x") and not pyramid.is_remote("/x")


def test_ome_xml(spark, tmp_path):
    (tmp_path / "m.xml").write_text('<OME><Image><Pixels PhysicalSizeX="0.14" PhysicalSizeY="0.14" PhysicalSizeZ="0.28" SizeC="2"><Channel ID="c:0" Name="ÂDAPI"/><Channel ID="c:1" Name="CD3"/></Pixels></Image></OME>', encoding="utf-8")
    assert sorted(map(tuple, omexml.channels(spark, str(tmp_path / "m.xml")).collect())) == [(0, "DAPI"), (1, "CD3")]
    assert omexml.voxel_size(spark, str(tmp_path / "m.xml")) == VoxelSize(0.14, 0.14, 0.28)


def blosc(data, width, codec, split):
    """A container of one block: bytes shuffled, then one stream or one for each byte position."""
    shuffled = np.frombuffer(data, np.uint8).reshape(-1, width).T.tobytes()
    n = width if split else 1
    streams = [pa.compress(shuffled[i * len(data) // n : (i + 1) * len(data) // n], codec={1: "lz4_raw", 4: "zstd"}[codec], asbytes=True) for i in range(n)]
    body = b"".join(len(s).to_bytes(4, "little") + s for s in streams)
    head = bytes([2, 1, 1 | (0 if split else 16) | codec << 5, width])
    return head + b"".join(x.to_bytes(4, "little") for x in (len(data), len(data), 20 + len(body))) + (20).to_bytes(4, "little") + body


CODECS = {
    None: lambda b: b, "gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress,
    "zstd": lambda b: pa.compress(b, codec="zstd", asbytes=True),
    "lz4": lambda b: len(b).to_bytes(4, "little") + pa.compress(b, codec="lz4_raw", asbytes=True),
    "blosc": lambda b: blosc(b, 2, 4, False),
}


def write_array(at, dense, chunks, codec=None, separator=".", fill=0, without=()):
    at.mkdir(parents=True, exist_ok=True)
    (at / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": dense.shape, "chunks": chunks, "dtype": dense.dtype.str, "compressor": codec and {"id": codec}, "fill_value": fill, "order": "C", "filters": None, "dimension_separator": separator}))
    for place in product(*(range(-(-n // c)) for n, c in zip(dense.shape, chunks))):
        if place in without:
            continue
        block = np.zeros(chunks, dense.dtype)
        part = dense[tuple(slice(i * c, (i + 1) * c) for i, c in zip(place, chunks))]
        block[tuple(slice(0, n) for n in part.shape)] = part
        file = at / separator.join(map(str, place))
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(CODECS[codec](block.tobytes()))


def dense_of(rows, like):
    back = np.zeros_like(like)
    for r in rows.collect():
        back[0, r.channel, r.z, r.y, r.x] = r.value
    return back


@pytest.mark.parametrize("codec", list(CODECS))
def test_arrays(spark, tmp_path, codec):
    dense = np.random.default_rng(0).integers(0, 3, (1, 2, 3, 5, 4)).astype("<u2")
    write_array(tmp_path / "a", dense, (1, 1, 3, 2, 4), codec, "/" if codec == "zstd" else ".")
    assert (dense_of(zarr.read_array(spark, str(tmp_path / "a")), dense) == dense).all()


def test_regions_levels_and_fill_values(spark, tmp_path):
    dense = np.random.default_rng(1).integers(1, 9, (1, 2, 3, 6, 8)).astype("<u2")
    write_array(tmp_path / "g" / "0", dense, (1, 1, 3, 2, 4), "zlib", fill=7, without=[(0, 1, 0, 2, 0)])
    write_array(tmp_path / "g" / "1", dense[..., ::2, ::2], (1, 2, 3, 3, 4))
    dense[0, 1, :, 4:6, :4] = 7
    volume = zarr.open_arrays(spark, str(tmp_path / "g"))
    assert [(v.key, v.shape, v.channels) for v in volume.levels] == [("0", Shape(3, 6, 8), 2), ("1", Shape(3, 3, 4), 2)]
    assert (dense_of(zarr.read_array(spark, str(tmp_path / "g"), "0"), dense) == dense).all()
    part = zarr.read_array(spark, str(tmp_path / "g"), "0", channels=(1,), y=(3, 6), x=(2, 7))
    want = np.zeros_like(dense)
    want[0, 1, :, 3:6, 2:7] = dense[0, 1, :, 3:6, 2:7]
    assert (dense_of(part, dense) == want).all()
    few = zarr.read_array(spark, str(tmp_path / "g"), "1", y=(0, 1))
    assert few.count() and {r.y for r in few.collect()} == {0}
    assert zarr.read_array(spark, str(tmp_path / "g"), "0", y=(6, 9)).count() == 0
    with pytest.raises(ValueError, match="no volume"):
        zarr.open_arrays(spark, str(tmp_path))
    with pytest.raises(ValueError, match="can't be read"):
        zarr.Array.parse("x", json.dumps({"zarr_format": 2, "shape": [1] * 5, "chunks": [1] * 5, "dtype": "<u2", "compressor": {"id": "other"}}))
    data = np.arange(4096, dtype="<u4").tobytes()
    assert zarr._blosc(blosc(data, 4, 1, True), len(data)) == data


def test_arrays_from_a_web_server(spark, tmp_path):
    import threading
    from functools import partial
    from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

    dense = np.random.default_rng(2).integers(0, 4, (1, 1, 2, 4, 4)).astype("<u2")
    write_array(tmp_path / "0", dense, (1, 1, 2, 2, 2), "gzip", without=[(0, 0, 0, 1, 1)])
    dense[0, 0, :, 2:, 2:] = 0
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    assert [v.key for v in zarr.open_arrays(spark, at).levels] == ["0"]
    assert (dense_of(zarr.read_array(spark, at, "0"), dense) == dense).all()
    server.shutdown()


ARGS = ["--tile", "4X4", "--vox", "1,1,2", "--min-vol-um3", "2", "--dilate-um", "0,1", "--min-marker-vox", "1", "--min-support-pair", "1", "--min-support-set", "1", "--hierarchy-levels", "2"]


def test_command_line(spark, tmp_path):
    dense, v = random_volume(spark)
    pyramid.rechunk(v, str(tmp_path / "v"), 4, 4)
    assert pyramid.roi(spark.read.parquet(str(tmp_path / "v")), x=(0, 4), channels=[1]).where("x >= 4").count() == 0
    one = pyramid.tile_voxels(spark, str(tmp_path / "v"), 1, 0, [0])
    assert one.count() == v.where("channel = 0 and x >= 4 and y < 4").count() and "PartitionFilters: [isnotnull(tile_x" in one._jdf.queryExecution().executedPlan().toString()
    assert cli.main(["run", "--voxels", str(tmp_path / "v"), "--output-dir", str(tmp_path / "o"), "--batch", "2", *ARGS], spark) == 0
    made = read_parquet(spark, str(tmp_path / "o" / "analysis"))
    assert made["combinations"].count() > 0
    full = np.zeros((1, 3, 3, 6, 7), "<u2")
    for r in v.collect():
        full[0, r.channel, r.z, r.y, r.x] = r.value
    write_array(tmp_path / "z", full, (1, 1, 2, 4, 4), "zlib")
    assert cli.main(["run", "--zarr-path", str(tmp_path / "z"), "--output-dir", str(tmp_path / "o"), "--output-name", "z", "--sqlite", *ARGS], spark) == 0
    again = read_parquet(spark, str(tmp_path / "o" / "z"))
    for name in ("combinations", "channel_stats"):
        cols = [c for c in made[name].columns if c != "id"]
        assert sorted(map(str, made[name].select(cols).collect())) == sorted(map(str, again[name].select(cols).collect()))
    assert (tmp_path / "o" / "z.db.gz").exists()
    assert cli.tile("128") == (128, 128) and cli.tile("128X256") == (128, 256) and cli.listed(int)("1,2") == (1, 2)
    with pytest.raises(SystemExit):
        cli.main(["run", *ARGS], spark)


def test_second_stage_alone_and_filter_by_folder(spark, tmp_path):
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    m = e.mine()
    at = str(tmp_path / "docs")
    checkpoints.write_json(checkpoints.documents(m, e.tiles(), CFG, 3), at)
    made, alone = e.result_tables(m), runs.aggregate_folder(spark, at, CFG, Shape(3, 6, 7))
    for name in made:
        cols = [c for c in made[name].columns if c not in ("id", "combination_id")]
        assert sorted(map(str, made[name].select(cols).collect())) == sorted(map(str, alone[name].select(cols).collect())), name
    assert runs.document_shape(checkpoints.read_json(spark, at)) == Shape(3, 8, 8)
    wanted = FilterConfig(min_inter_vox=4, min_tiles_present=2)
    counts = runs.filter_folder(spark, at, str(tmp_path / "kept"), wanted).first()
    kept, want = checkpoints.flat(checkpoints.read_json(spark, str(tmp_path / "kept"))), runs.filter_results(m, wanted)[0]
    cols = ["tile_x", "tile_y", "r_um", "inter_vox", "union_vox", "overlap_coeff"]
    for part, key in (("pairs", ["a", "b"]), ("sets", ["members", "member_vox"])):
        a, b = (sorted(map(str, getattr(x, part).select(*key, *cols).collect())) for x in (kept, want))
        assert a == b and len(a) == counts[f"{part}_after"] <= counts[f"{part}_before"]
    assert kept.channel_stats.count() == m.channel_stats.count()
    tables, again = runs.filter_and_aggregate_folder(spark, at, CFG, wanted)
    assert again.first() == counts and tables["combinations"].where("hierarchy_level = 0").count() == counts.pairs_after + counts.sets_after
    assert cli.main(["filter", "--documents", at, "--target", str(tmp_path / "t"), "--filter-min-inter-vox", "4", "--filter-min-tiles-present", "2"], spark) == 0
    assert checkpoints.flat(checkpoints.read_json(spark, str(tmp_path / "t"))).pairs.count() == counts.pairs_after
    assert cli.main(["aggregate", "--documents", at, "--output-dir", str(tmp_path / "p"), *ARGS], spark) == 0
    assert read_parquet(spark, str(tmp_path / "p" / "analysis"))["tiles"].count() > 0


def test_tiles_mined_again_keep_nothing_of_before(spark, tmp_path):
    _, v = random_volume(spark)
    store = ResultStore(spark, str(tmp_path / "s"), CFG)
    assert store.read().pairs.count() == 0 and store.done().count() == 0
    store.write(Engine(v, Shape(3, 6, 7), CFG, lowres=v).mine())
    assert store.read().pairs.where("tile_x = 0").count() > 0
    gone = Engine(v.where("x >= 4"), Shape(3, 6, 7), CFG, lowres=v)
    store.write(gone.mine(gone.tiles().where("tile_x = 0")))
    again = store.read()
    assert again.pairs.where("tile_x = 0").count() == 0 and again.pairs.where("tile_x = 1").count() > 0
    assert again.summary.count() == 4 and again.channel_stats.count() == 4 * 3 * 3
    few = EngineConfig(**{**CFG.__dict__, "max_set_size": 2})
    pairs_only = ResultStore(spark, str(tmp_path / "few"), few)
    got = runs.run_tiles(Engine(v, Shape(3, 6, 7), few), pairs_only)
    assert got.sets.count() == 0 and got.pairs.count() > 0


def test_a_run_that_ends_early_goes_on(spark, tmp_path):
    _, v = random_volume(spark)
    e = Engine(v, Shape(3, 6, 7), CFG)
    store = ResultStore(spark, str(tmp_path / "s"), CFG)

    class Stop(Exception):
        pass

    def stop(progress):
        assert (progress.done, progress.of) == (2, 4) and progress.per_second > 0 and "2/4" in str(progress)
        raise Stop

    with pytest.raises(Stop):
        runs.run_tiles(e, store, batch=2, report=stop)
    assert store.done().count() == 2
    rest = e.only(remaining(e.tiles(), store.done()))
    assert rest.tiles().count() == 2 and rest.voxels.select("tile_y").distinct().count() == 1
    cols = [c for c in e.mine().pairs.columns if c != "r_idx"]
    assert sorted(map(str, runs.run_tiles(e, store, batch=2).pairs.select(cols).collect())) == sorted(map(str, e.mine().pairs.select(cols).collect()))


def test_streamed_tiles_equal_a_batch(spark, tmp_path):
    _, v = random_volume(spark)
    shape = Shape(3, 6, 7)
    v.where("x < 4").coalesce(1).write.parquet(str(tmp_path / "in"))
    store = ResultStore(spark, str(tmp_path / "store"), CFG)
    known = lambda: spark.read.schema(VOXELS).parquet(str(tmp_path / "in"))
    run = lambda: mine_stream(stream_voxels(spark, str(tmp_path / "in")), shape, CFG, v, store, str(tmp_path / "state"), known).awaitTermination()
    run()
    assert store.done().count() == 2
    v.where("x >= 4").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    want = Engine(v, shape, CFG, lowres=v).mine().pairs
    cols = [c for c in want.columns if c != "r_idx"]
    assert sorted(map(str, store.read().pairs.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
