"""Column statistics of Parquet files, from their footers."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.types import comparable, to_json

#: Up to so many files the driver reads the footers itself; beyond, a Spark job does.
DRIVER_FILES = 64


def opened(path: str) -> Any:
    """An open file of a Hadoop path, whose name is not escaped as in a URI."""
    import pyarrow.fs as pafs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    authority, _, name = rest.lstrip("/").partition("/")
    fs, _ = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs.open_input_file(f"{authority}/{name}" if scheme in ("s3", "s3a", "gs") else f"/{name}")


def footer(path: str, schema: T.StructType) -> dict[str, Any]:
    """rows, and by column: bytes, values, nulls, lower, upper. What any row group lacks is left out.

    Bounds are kept for columns at the top level that have an order, never NaN.
    """
    import pyarrow.parquet as pq

    with opened(path) as f:
        meta = pq.ParquetFile(f).metadata
    kinds = {f.name: f.dataType for f in schema.fields}
    columns: dict[str, dict[str, Any]] = {}
    for g in range(meta.num_row_groups):
        for c in range(meta.num_columns):
            chunk = meta.row_group(g).column(c)
            name = chunk.path_in_schema
            at_c = columns.setdefault(name, {"bytes": 0, "values": 0, "nulls": 0, "lower": [], "upper": []})
            at_c["bytes"] += chunk.total_compressed_size
            at_c["values"] += chunk.num_values
            s = chunk.statistics
            if at_c["nulls"] is not None:
                at_c["nulls"] = at_c["nulls"] + s.null_count if s is not None and s.has_null_count else None
            if s is not None and s.has_null_count and s.null_count == chunk.num_values:
                continue  # a row group of nulls bounds nothing
            known = s is not None and s.has_min_max and name in kinds
            try:
                at_c["lower"].append(comparable(s.min, kinds[name]) if known else None)
                at_c["upper"].append(comparable(s.max, kinds[name]) if known else None)
            except (ValueError, TypeError, AttributeError):
                at_c["lower"].append(None)
    for v in columns.values():
        bad = not v["lower"] or None in v["lower"] or None in v["upper"] or len(v["lower"]) != len(v["upper"])
        v["lower"], v["upper"] = (None, None) if bad else (to_json(min(v["lower"])), to_json(max(v["upper"])))
    return {"rows": meta.num_rows, "columns": columns}


def rows_of(spark: SparkSession, paths: list[str], file_format: str) -> dict[str, dict]:
    """Row counts alone, for formats whose footers are not read. Spark names the files as escaped URIs."""
    from urllib.parse import unquote

    from pyspark.sql import functions as F

    if not paths:
        return {}
    plain = lambda p: p.partition(":")[0] + ":/" + p.partition(":")[2].lstrip("/")
    got = spark.read.schema("_c string").format(file_format).load(paths).groupBy(F.input_file_name().alias("p")).count().collect()
    known = {plain(unquote(r["p"])): r["count"] for r in got}
    return {p: {"rows": known.get(plain(p), 0), "columns": {}} for p in paths}


def footers(spark: SparkSession, paths: list[str], schema: T.StructType) -> dict[str, dict]:
    """The metrics of each file: by threads of the driver, or by tasks that hold a few files each."""
    if len(paths) <= DRIVER_FILES:
        with ThreadPoolExecutor(8) as pool:
            return dict(zip(paths, pool.map(lambda p: footer(p, schema), paths)))
    import json

    text = schema.json()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = T.StructType.fromJson(json.loads(text))
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "metrics": [json.dumps(footer(p, own)) for p in batch["path"]]})

    parts = max(1, len(paths) // 16)
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(parts).mapInPandas(run, "path string, metrics string").collect()
    return {r["path"]: json.loads(r["metrics"]) for r in rows}
