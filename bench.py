"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tessera.functions import geometry
from tessera.operators import block_resample
from tessera.plans.catalogue import ANGLE, DX, DZ, QUERIES
from tessera.sources import blocks, tables

NAMES = ("topview", "affine_resample_f32", "pyramid_levels", "compare_summary", "depth_resample", "page_ncc", "concat_depth", "pyramid_lineitem")


def block_queries(spark: SparkSession, sf_dir: str) -> dict:
    """The same resamplings in block form, and a larger synthetic volume."""
    shape = tables.embedding_shape(spark, sf_dir)
    packed = blocks.from_voxels(tables.embedding_volume(spark, sf_dir), shape, (1, *shape[1:]))
    view, record = geometry.top_view(shape, DX, DZ, ANGLE), geometry.affine(shape, DX, DZ, ANGLE)
    big = (128, 256, 256)
    stress = blocks.synthetic_planes(spark, big)
    return {
        "topview_block": lambda: block_resample.top_view_planes(packed, view),
        "affine_block": lambda: block_resample.affine_blocks(packed, record),
        "topview_stress_block": lambda: block_resample.top_view_planes(stress, geometry.top_view(big, DX, DZ, ANGLE)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tessera-bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {n: (lambda f=QUERIES[n]: f(spark, sf_dir)) for n in NAMES} | block_queries(spark, sf_dir)
    took = {}
    for name, make in runs.items():
        times = []
        for _ in range(4):  # the first warms up
            began = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
