"""The result tables at rest: Parquet for Spark, one gzip SQLite file for other tools."""

from __future__ import annotations

import gzip
import os
import shutil
import sqlite3
import tempfile
import uuid
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed format of the exchanged file.
DDL = {
    "metadata": "key TEXT PRIMARY KEY, value TEXT",
    "combinations": "id INTEGER PRIMARY KEY, channels TEXT, channel_count INTEGER, dilation REAL, hierarchy_level INTEGER, total_count INTEGER, total_union INTEGER, iou REAL, overlap_coeff REAL",
    "tiles": "combination_id INTEGER, tile_x0 INTEGER, tile_x1 INTEGER, tile_y0 INTEGER, tile_y1 INTEGER, inter_count INTEGER, union_count INTEGER",
    "channel_stats": "channel TEXT, channel_idx INTEGER, dilation REAL, hierarchy_level INTEGER, tile_x0 INTEGER, tile_x1 INTEGER, tile_y0 INTEGER, tile_y1 INTEGER, voxel_count INTEGER, sum_intensity REAL, mean_intensity REAL",
}
#: Columns of each index; those of places serve lookups by region.
INDEXED = {
    "combinations": (("channels",), ("hierarchy_level", "dilation"), ("iou",)),
    "tiles": (("combination_id",), ("tile_x0", "tile_x1", "tile_y0", "tile_y1")),
    "channel_stats": (("channel",), ("hierarchy_level", "dilation"), ("tile_x0", "tile_x1", "tile_y0", "tile_y1")),
}
KEYS = {"tiles": ", FOREIGN KEY (combination_id) REFERENCES combinations (id)"}
SPARK = {"TEXT": "string", "INTEGER": "long", "REAL": "double"}
#: Rows of a bucket of combinations and tiles, about, and what each stored table is sorted by.
BUCKET_ROWS = 4_000_000
SORTED = {"combinations": ["hierarchy_level", "dilation", "channels"], "tiles": ["place"], "channel_stats": ["hierarchy_level", "dilation", "channel", "place"]}
BUCKETED = {"combinations": "id", "tiles": "combination_id"}


def place(x: str, y: str) -> Column:
    """Bits of two columns of numbers from 0 in turn (the Z-order curve): what is near on the plane is near in this order."""

    def apart(name: str) -> Column:
        v = F.col(name).cast("long").bitwiseAND(0xFFFFFFFF >> 1)
        for by, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, by)).bitwiseAND(F.lit(mask))
        return v

    return apart(x).bitwiseOR(F.shiftleft(apart(y), 1))


def write_parquet(tables: dict[str, DataFrame], path: str, bucket_rows: int = BUCKET_ROWS, options: dict[str, str] | None = None) -> None:
    """One folder per table, laid out for lookups.

    combinations and tiles are dealt to as many buckets by the combination's number, so that joining them shuffles neither (see open_tables()). Within a
    bucket combinations are sorted by level, radius and channels, tiles by place: lookups by name or region skip row groups. channel_stats has
    folders by level and radius, range partitions by channel and place within: no level is written by one task. options are Parquet's.
    """
    spark, options = tables["combinations"].sparkSession, options or {}
    path = _whole(spark, path)
    buckets = 1
    while buckets * bucket_rows < tables["combinations"].count():
        buckets *= 2
    tables = {name: df.withColumn("place", place("tile_x0", "tile_y0")) if "place" in SORTED.get(name, []) else df for name, df in tables.items()}
    for name, df in tables.items():
        at = f"{path}/{name}"
        if name in BUCKETED:
            key, table = BUCKETED[name], _table_name(path, name)
            df.repartition(buckets, key).write.mode("overwrite").options(**options, path=at).bucketBy(buckets, key).sortBy(*SORTED[name]).saveAsTable(table, format="parquet")
            spark.sql(f"DROP TABLE {table}")  # the session's entry, not the files
        elif name == "channel_stats":
            df.repartitionByRange(*SORTED[name]).sortWithinPartitions(*SORTED[name]).write.mode("overwrite").options(**options).partitionBy("hierarchy_level", "dilation").parquet(at)
        else:
            df.write.mode("overwrite").parquet(at)
    spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{path}/layout")


def _whole(spark: SparkSession, path: str) -> str:
    """A path with its file system, since the catalog takes bare ones as below its own folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _columns(name: str) -> list[str]:
    return [c.split()[0] for c in DDL[name].split(", ")]


def _table_name(path: str, name: str) -> str:
    return f"covoxel_{sha256(path.rstrip('/').encode()).hexdigest()[:12]}_{name}"


def read_parquet(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}").select(_columns(name)) for name in DDL}


def open_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of such a folder with what their layout is good for: the session's catalog learns the buckets, so that combinations and
    tiles join without a shuffle."""
    path = _whole(spark, path)
    out = read_parquet(spark, path)
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    for name, key in BUCKETED.items():
        table, stored = _table_name(path, name), spark.read.parquet(f"{path}/{name}").schema
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({', '.join(SORTED[name])}) INTO {buckets} BUCKETS LOCATION '{path}/{name}'")
        out[name] = spark.table(table).select(_columns(name))
    return out


def in_region(rows: DataFrame, x: tuple[int, int], y: tuple[int, int]) -> DataFrame:
    """Rows of tiles or channel_stats whose region meets a rectangle of tiles (first and end); as filters that reach the scan."""
    return rows.where((F.col("tile_x0") < x[1]) & (F.col("tile_x1") > x[0]) & (F.col("tile_y0") < y[1]) & (F.col("tile_y1") > y[0]))


def export_sqlite(tables: dict[str, DataFrame], target: str) -> None:
    """Write the tables into one gzip SQLite file on the driver, row by row from an iterator that holds one partition at a time."""
    with tempfile.TemporaryDirectory() as folder:
        file = os.path.join(folder, "tables.db")
        with sqlite3.connect(file) as db:
            for name, columns in DDL.items():
                db.execute(f"CREATE TABLE {name} ({columns}{KEYS.get(name, '')})")
                names = _columns(name)
                rows = tables[name].select(*names).toLocalIterator(prefetchPartitions=True)
                db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(names))})", map(tuple, rows))
                for cols in INDEXED.get(name, ()):
                    db.execute(f"CREATE INDEX idx_{name}_{'_'.join(cols)} ON {name} ({', '.join(cols)})")
        db.close()
        part = f"{target}.part"
        with open(file, "rb") as source, gzip.open(part, "wb") as out:
            shutil.copyfileobj(source, out)
        os.replace(part, target)


def import_sqlite(spark: SparkSession, source: str, rows: int = 100_000) -> dict[str, DataFrame]:
    """The tables of such a file as DataFrames. It is one file on the driver, read and handed on `rows` rows at a time as
    Parquet in the folder that executors share, or, where the session names none, as local frames."""
    out = {}
    shared = spark.conf.get("spark.checkpoint.dir", None)
    with tempfile.NamedTemporaryFile(suffix=".db") as file:
        with gzip.open(source, "rb") as packed:
            shutil.copyfileobj(packed, file)
        file.flush()
        db = sqlite3.connect(file.name)
        for name, columns in DDL.items():
            kinds = [(c.split()[0], SPARK[c.split()[1]]) for c in columns.split(", ")]
            schema, found = ", ".join(f"{c} {k}" for c, k in kinds), db.execute(f"SELECT {', '.join(c for c, _ in kinds)} FROM {name}")
            at = shared and f"{shared.rstrip('/')}/import-{uuid.uuid4().hex}"
            table = spark.createDataFrame([], schema)
            while part := found.fetchmany(rows):
                frame = spark.createDataFrame(part, schema)
                if at:
                    frame.write.mode("append").parquet(at)
                    table = spark.read.schema(schema).parquet(at)
                else:
                    table = table.unionAll(frame)
            out[name] = table
        db.close()
    return out
