"""Names, labels and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known spelling errors in the published boundary files.
NAME_CORRECTIONS = {"Muchiga": "Muchinga"}
NAME_COLUMNS = ("NAM_1", "NAM_2")

# Table name patterns; adm is "" for the country or "_<province>_province".
EXTRACT_TABLES = {
    "boundaries": "wb_boundaries_{iso}{adm}",
    "population": "population_{iso}_{year}{adm}",
    "facilities": "health_facilities_{iso}_osm{adm}",
    "lgu": "wb_boundaries_lgu_{country}{adm}",
}
TRANSFORM_TABLES = {
    "boundaries": "wb_boundaries_{iso}{adm}",
    "facilities": "health_facilities_{iso}_osm{adm}",
    "population": "population_{iso}_{year}",
    "population_aoi": "population_aoi_{iso}_{year}{adm}_{km}",
    "facilities_h3": "facilities_h3_{iso}{adm}_{km}",
    "facilities_coverage": "facilities_coverage_{iso}{adm}_{km}",
    "potential_locations": "potential_locations_{iso}{adm}_{km}",
    "potential_coverage": "potential_coverage_{iso}{adm}_{km}",
    "lgu": "wb_boundaries_lgu_{country}",
    "lgu_accessibility": "lgu_accessibility_results_{iso}{adm}_{km}",
}


def table_names(
    catalog: str, schema: str, country: str, iso3: str, province: str | None, year: int, distance_m: int | None = None
) -> dict[str, str]:
    """Fully qualified table names: extract tables, or transform tables when a distance is given."""
    fill = {
        "iso": iso3.lower(),
        "country": country.lower(),
        "year": year,
        "adm": "" if province is None else f"_{province.lower().replace('-', '_')}_province",
        "km": "" if distance_m is None else f"{int(distance_m / 1000)}km",
    }
    patterns = EXTRACT_TABLES if distance_m is None else TRANSFORM_TABLES
    return {key: f"{catalog}.{schema}.{pattern.format(**fill)}" for key, pattern in patterns.items()}


def combinations(provinces: list[str] | None, distances_m: list[int]) -> list[tuple[str | None, int]]:
    """(province, distance) pairs; no provinces means the country (None)."""
    return [(province, d) for province in (provinces or [None]) for d in distances_m]


def combinations_df(regions: DataFrame, distances_m, region: str = "region", include_country: str | None = None) -> DataFrame:
    """The same over a table of region names, one output row per region and distance.

    ``include_country`` adds that label as a region of its own.
    """
    names = regions.select(F.col(region).alias("region")).distinct()
    if include_country is not None:
        names = names.withColumn(
            "region", F.explode(F.array(F.col("region"), F.lit(include_country)))
        ).distinct()
    return names.withColumn("distance_m", F.explode(F.array(*[F.lit(int(d)) for d in distances_m])))


def km_label(distance_m: Column) -> Column:
    return F.concat(F.floor(distance_m / 1000).cast("string"), F.lit("km"))


def region_label(name: Column) -> Column:
    """Lower case with ``-`` as ``_``: the form names take inside table names."""
    return F.replace(F.lower(name), F.lit("-"), F.lit("_"))


def sanitize_name(name: Column) -> Column:
    """Display name to column name: runs of other characters become one ``_``, prefix ``lgu_``."""
    return F.concat(F.lit("lgu_"), F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9]+", "_"), r"^_|_$", ""))


def dedupe_columns(columns: list[str]) -> list[str]:
    """Rename columns that differ only in case: ``_dup``, then ``_`` until unique."""
    taken: set[str] = set()
    out = []
    for name in columns:
        if name.lower() in taken:
            name += "_dup"
            while name.lower() in taken:
                name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_unique_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*dedupe_columns(df.columns))


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share exactly one name."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    keep = {}
    for position, name in enumerate(df.columns):
        keep.setdefault(name, names[position])
    return df.toDF(*names).select(*[F.col(source).alias(name) for name, source in keep.items()])


def rename_ignoring_case(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename the column spelt exactly ``old`` and no other spelling of it."""
    return df.toDF(*[new if c == old else c for c in df.columns])


def correct_names(df: DataFrame, corrections: dict[str, str] | None = None) -> DataFrame:
    subset = [c for c in NAME_COLUMNS if c in df.columns]
    return df.replace(corrections or NAME_CORRECTIONS, subset=subset) if subset else df


def pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; 0 when there is nobody to reach."""
    return F.when(whole > 0, F.floor(F.coalesce(part, F.lit(0)) * 100.0 / whole * 100.0 + 0.5) / 100.0).otherwise(F.lit(0.0))


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)
