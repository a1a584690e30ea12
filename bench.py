"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Pixels are the order lines (the densest table). Every query starts from the parquet files; the result is
computed in full and thrown away. One query at the smallest scale warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from isoreach.operators import coverage, layers, polyfill, population  # noqa: E402
from isoreach.plans import fixtures as fx  # noqa: E402
from isoreach.plans import queries as q  # noqa: E402
from isoreach.plans.fixtures import DISTANCES, GRID  # noqa: E402


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("isoreach-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def area(spark: SparkSession, sf_dir: str, max_new: int = 55) -> q.Area:
    return q.Area(spark, sf_dir, max_new, fx.dense_pixels(spark, sf_dir))


def headline(spark: SparkSession, sf_dir: str) -> dict:
    def aoi() -> DataFrame:
        return area(spark, sf_dir).aoi()

    def access() -> DataFrame:
        a = area(spark, sf_dir)
        return coverage.facility_access(a.existing(), a.weights(), DISTANCES, GRID)

    def candidates() -> DataFrame:
        a = area(spark, sf_dir)
        return coverage.facility_access(a.candidates(), a.weights(), DISTANCES, GRID)

    def sample() -> DataFrame:
        a = area(spark, sf_dir)
        pixels = a.aoi().withColumnRenamed("h3_index", "cell")
        layer = layers.layer_pixels(pixels, a.covered(), False, polyfill.max_cells(a.regions, GRID))
        return layers.sample_exact(layer, ["region", "distance_m"], "ID", 5_000)

    return {
        "population_by_cell": lambda: population.population_by_cell(fx.dense_pixels(spark, sf_dir)),
        "population_aoi": aoi,
        "opacity_bands": lambda: population.density_bands(aoi()),
        "polyfill": lambda: q.QUERIES["polyfill"](spark, sf_dir),
        "facilities_within": lambda: area(spark, sf_dir).existing(),
        "facility_access": access,
        "candidate_access": candidates,
        "coverage_pairs": lambda: area(spark, sf_dir).pairs(),
        "access_summary": lambda: area(spark, sf_dir).summary(),
        "mclp_55_steps": lambda: area(spark, sf_dir).steps(),
        "lgu_access": lambda: area(spark, sf_dir).curves(),
        "layer_sample": sample,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    only = sys.argv[1:]
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    q.QUERIES["access_summary"](spark, smallest if os.path.isdir(smallest) else sf_dir).collect()
    times = {}
    for name, make in headline(spark, sf_dir).items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
