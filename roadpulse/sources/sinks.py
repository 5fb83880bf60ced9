"""Writers: CSV, Parquet, and a GeoPackage for the few rows of a corridor."""

from __future__ import annotations

import os
import sqlite3
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geometry import parse_lines

#: Rows that a GeoPackage layer may have: it is one local file that the driver writes.
LAYER_ROWS = 100_000


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """A folder of CSV files with headers and times to the microsecond; rows in order across the files if ``order`` is given."""
    writer = (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def write_parquet(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def _wkb(lines: list) -> bytes:
    def part(points: list) -> bytes:
        return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in points)

    return part(lines[0]) if len(lines) == 1 else struct.pack("<BII", 1, 5, len(lines)) + b"".join(part(p) for p in lines)


def geopackage_layer(df: DataFrame, geometry: str) -> DataFrame:
    """Rows whose geometry is a line, with it in ``geom``."""
    return df.withColumn("geom", parse_lines(F.col(geometry))).filter(F.col("geom").isNotNull())


def write_geopackage(path: str, layers: dict[str, DataFrame]) -> None:
    """Layers made by ``geopackage_layer`` as one file in EPSG:4326; a file that is there is replaced, layers without rows are left out."""
    if os.path.exists(path):
        os.unlink(path)
    with sqlite3.connect(path) as db:
        db.execute("PRAGMA application_id = 0x47504B47")
        db.execute("PRAGMA user_version = 10300")
        db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER)")
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name))")
        wgs84 = 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433]]'
        db.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?,?,?,?,?,NULL)", [("WGS 84", 4326, "EPSG", 4326, wgs84), ("Undefined Cartesian", -1, "NONE", -1, "undefined"), ("Undefined geographic", 0, "NONE", 0, "undefined")])
        for name, df in layers.items():
            rows = df.limit(LAYER_ROWS + 1).collect()
            if len(rows) > LAYER_ROWS:
                raise ValueError(f"layer {name} has more than {LAYER_ROWS} rows")
            if not rows:
                continue
            kinds = {"string": "TEXT", "double": "REAL", "float": "REAL", "boolean": "BOOLEAN"}
            cols = [(c, kinds.get(t, "INTEGER" if t in ("int", "bigint", "smallint", "tinyint") else "TEXT")) for c, t in df.dtypes if c != "geom"]
            quoted = ", ".join(f'"{c}" {t}' for c, t in cols)
            db.execute(f'CREATE TABLE "{name}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB, {quoted})')
            header = b"GP" + struct.pack("<BBi", 0, 1, 4326)
            plain = lambda v: v if v is None or isinstance(v, int | float | str) else str(v)
            db.executemany(
                f'INSERT INTO "{name}" (geom, {", ".join(f"{chr(34)}{c}{chr(34)}" for c, _ in cols)}) VALUES ({",".join("?" * (len(cols) + 1))})',
                [(header + _wkb(r["geom"]), *[plain(r[c]) for c, _ in cols]) for r in rows],
            )
            xs = [p["x"] for r in rows for part in r["geom"] for p in part]
            ys = [p["y"] for r in rows for part in r["geom"] for p in part]
            db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?,?,?,?,?,?,?,?)", (name, "features", name, min(xs), min(ys), max(xs), max(ys), 4326))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?,?,?,?,0,0)", (name, "geom", "GEOMETRY", 4326))
