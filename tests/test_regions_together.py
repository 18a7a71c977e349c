"""Small groups are labelled and dilated many at a time, with the results of each alone."""

import numpy as np
import pyarrow as pa
import pytest

from covoxel.operators import components
from covoxel.operators.tiling import Shape
from tests.test_operators import CFG

SHAPE = Shape(3, 6, 7)
COLUMNS = {"channel": "int", "tile_x": "int", "tile_y": "int", "z": "int", "y": "int", "x": "int", "value": "double"}


class Rows:
    """Stands for a DataFrame and keeps the function that its tasks would run."""

    dtypes = list(COLUMNS.items())

    def repartition(self, *_):
        return self

    sortWithinPartitions = groupBy = repartition

    def mapInArrow(self, task, _):
        return task


@pytest.fixture
def volume():
    rng = np.random.default_rng(3)
    z, y, x = np.nonzero(rng.random((SHAPE.z, SHAPE.y, 2 * SHAPE.x)) < 0.3)  # two channels side by side
    channel, x = x // SHAPE.x, x % SHAPE.x
    tx, ty = x // CFG.tile_x, y // CFG.tile_y
    order = np.lexsort((ty, tx, channel))
    ints = [pa.array(a[order].astype(np.int32)) for a in (channel, tx, ty, z, y, x)]
    return pa.table([*ints, pa.array(rng.random(len(x)))], names=list(COLUMNS))


def results(volume, cells, batch, monkeypatch):
    called, real = [], components.label
    monkeypatch.setattr(components, "CELLS", cells)
    monkeypatch.setattr(components, "label", lambda *args: called.append(1) or real(*args))
    out = pa.Table.from_batches(components.regions(Rows(), SHAPE, CFG)(iter(volume.combine_chunks().to_batches(max_chunksize=batch))))
    monkeypatch.setattr(components, "label", real)
    return out.sort_by([(c, "ascending") for c in out.column_names]), len(called)


def test_groups_together_equal_each_alone(volume, monkeypatch):
    groups = len(components._groups(volume))
    alone, calls = results(volume, 1, 10_000, monkeypatch)
    assert calls == groups == 8 and alone.column("min_d2").null_count == volume.num_rows < alone.num_rows
    for batch in (1, 7, 10_000):
        assert results(volume, 1 << 20, batch, monkeypatch)[0].equals(alone)
    assert results(volume, 1 << 20, 10_000, monkeypatch)[1] == 2  # the last group waits for the end


def test_no_rows(volume, monkeypatch):
    assert list(components.regions(Rows(), SHAPE, CFG)(iter(volume.slice(0, 0).to_batches()))) == []
