"""Silver tables to the integrated gold table and the data products."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.temporal import month_start
from strata.lake import Lake
from strata.operators.enrich import EVOLVED_COLUMNS, context_tables, enrich
from strata.operators.lookup import fits_broadcast
from strata.plans import analytics
from strata.plans.concurrent import side_by_side
from strata.plans.runs import last_commit, last_commits, record_run, should_refresh
from strata.sources.files import list_files
from strata.sources.tables import cluster_for_write, current_path, read_table, remove_table, table_exists, write_table

INTEGRATED = "integrated_taxi_trips"
INTEGRATED_BY_BOROUGH = "integrated_taxi_trips_by_borough"
DATA_SOURCE = f"gold/{INTEGRATED}"


@dataclass(frozen=True)
class Product:
    name: str
    build: Callable[[DataFrame], DataFrame]
    partition_by: tuple[str, ...] = ()


PRODUCTS = (
    Product("daily_borough_mobility", analytics.daily_borough_mobility, ("pickup_date",)),
    Product("taxi_zone_monthly_demand", analytics.monthly_zone_demand, ("trip_month",)),
    Product("weather_impact_summary", analytics.weather_impact_summary),
    Product("air_quality_demand_summary", analytics.air_quality_demand_summary),
    Product("zone_weather_sensitivity", analytics.zone_weather_sensitivity),
)


def _count_and_write(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), *, cluster: bool = True, dynamic: bool = False
) -> int:
    counted = Observation()
    framed = (cluster_for_write(df, list(partition_by)) if cluster else df).observe(counted, F.count(F.lit(1)).alias("rows"))
    write_table(framed, path, list(partition_by), cluster=False, dynamic=dynamic)
    return counted.get["rows"]


SILVER_TABLES = ("taxi_trips", "weather", "air_quality", "taxi_zones")


def write_integrated(
    spark: SparkSession, lake: Lake, run_id: str, days: Sequence[str] | None = None, keep_extra: bool = False
) -> int:
    """Write the integrated table by date: whole, or only the given days of it in place of what they held.

    The hourly tables are computed once and written to the staging area; Spark's estimate of those files decides how
    they are joined.  When all context tables are small enough to broadcast, trips go from the silver scan to the gold
    files without a shuffle: silver has the same date partitions, so the files stay as few as they were.
    """
    trips, weather, air, zones = (read_table(spark, lake.silver(t)) for t in SILVER_TABLES)
    if days is not None:
        trips, weather, air = (
            df.filter(on_days(c, days))
            for df, c in ((trips, "pickup_date"), (weather, "observation_date"), (air, "measurement_date"))
        )
    zones, weather, air = context_tables(weather, air, zones, keep_extra)
    staging = lake.staging(f"context-{run_id}")
    weather, air = (
        read_table(spark, write_table(hourly, f"{staging}/{name}")) for name, hourly in (("weather", weather), ("air", air))
    )
    shuffled = not all(fits_broadcast(side) for side in (zones, weather, air))
    wide = enrich(trips, zones, weather, air, keep_extra=keep_extra)
    rows = _count_and_write(wide, lake.gold(INTEGRATED), ("pickup_date",), cluster=shuffled, dynamic=days is not None)
    remove_table(spark, staging)
    return rows


def integrate(
    spark: SparkSession, lake: Lake, *, write_borough_layout: bool = True, keep_extra: bool = False, force: bool = True
) -> DataFrame:
    """Build the integrated table by date and, from that written table, the layout by borough.

    The second layout reads the first one back: a written table is cheaper to rely on than a cached wide frame,
    and losing executors between the two writes costs nothing.  Without ``force`` nothing is done while no silver table
    was written after the integrated one.
    """
    path = lake.gold(INTEGRATED)
    if not force and not integrated_is_stale(spark, lake):
        return read_table(spark, path)
    with record_run(spark, lake, "gold", INTEGRATED) as run:
        rows = write_integrated(spark, lake, run.known["run_id"], keep_extra=keep_extra)
        if write_borough_layout:
            by_date = read_table(spark, path)
            write_table(by_date, lake.gold(INTEGRATED_BY_BOROUGH), ("pickup_borough",))
        run.loaded(rows)
    return read_table(spark, path)


def integrated_is_stale(spark: SparkSession, lake: Lake) -> bool:
    silver = last_commits(spark, lake, {t: lake.silver(t) for t in SILVER_TABLES}, "silver")
    return should_refresh(last_commit(spark, lake, INTEGRATED, lake.gold(INTEGRATED)), list(silver.values()))


def schema_version(integrated: DataFrame) -> str:
    """Moves to 1.1 once an evolved column has arrived."""
    return "1.1" if any(c in integrated.columns for c in EVOLVED_COLUMNS) else "1.0"


def with_provenance(
    df: DataFrame, version: str = "1.0", source: str = DATA_SOURCE, created_at: datetime | None = None
) -> DataFrame:
    """Provenance columns.  ``created_at`` carries the first creation time over a refresh."""
    now = F.current_timestamp()
    return df.withColumns(
        {
            "_data_source": F.lit(source),
            "_created_at": now if created_at is None else F.lit(created_at).cast("timestamp"),
            "_refreshed_at": now,
            "_schema_version": F.lit(version),
        }
    )


def first_created(spark: SparkSession, path: str) -> datetime | None:
    """Creation time recorded in an existing product."""
    if not table_exists(spark, path):
        return None
    existing = read_table(spark, path)
    return existing.agg(F.min("_created_at")).first()[0] if "_created_at" in existing.columns else None


def write_product(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), version: str = "1.0", source: str = DATA_SOURCE
) -> int:
    """Replace a product, keeping its creation time; returns the rows written."""
    created = first_created(df.sparkSession, path)
    return _count_and_write(with_provenance(df, version, source, created), path, partition_by)


def write_product_slice(df: DataFrame, path: str, partition_by: Iterable[str], version: str = "1.0") -> int:
    """Replace only the partitions that occur in ``df``, keeping the product's creation time; returns the rows written."""
    created = first_created(df.sparkSession, path)
    return _count_and_write(with_provenance(df, version, created_at=created), path, partition_by, dynamic=True)


# --- refresh of what has changed ------------------------------------------------------------------------------------


def partition_commits(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(value, at): when each partition of ``column`` got its newest file, from a distributed listing of names."""
    value = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
    listed = list_files(spark, current_path(spark, path)).filter(F.col("path").endswith(".parquet"))
    return listed.groupBy(value.alias("value")).agg(F.max("modified_at").alias("at"))


def newer_partitions(upstream: DataFrame, target: DataFrame) -> list[str]:
    """Values whose partition upstream is not older than the target's, or which the target lacks.  There is one per day
    or month at most, and the driver needs them to select the partitions to read."""
    both = upstream.join(target.withColumnRenamed("at", "target_at"), "value", "left")
    return [r["value"] for r in both.filter(F.col("target_at").isNull() | (F.col("at") >= F.col("target_at"))).orderBy("value").collect()]


def on_days(column: str, days: Sequence[str]) -> Column:
    return F.col(column).isin([F.lit(day).cast("date") for day in days])


def changed_days(spark: SparkSession, lake: Lake) -> list[str] | None:
    """Days whose trips, weather or air changed after the integrated table was written; none if all of it has to be."""
    path = lake.gold(INTEGRATED)
    if not table_exists(spark, path):
        return None
    zones = list_files(spark, current_path(spark, lake.silver("taxi_zones"))).agg(F.max("modified_at")).first()[0]
    known = partition_commits(spark, path, "pickup_date")
    oldest = known.agg(F.min("at")).first()[0]
    if oldest is None or (zones and zones >= oldest):
        return None
    trips = partition_commits(spark, lake.silver("taxi_trips"), "pickup_date")
    days = set(newer_partitions(trips, known))
    there = {r["value"] for r in trips.select("value").collect()}
    for table, column in (("weather", "observation_date"), ("air_quality", "measurement_date")):
        # A day without trips has no place in the integrated table, whatever its weather.
        days |= there.intersection(newer_partitions(partition_commits(spark, lake.silver(table), column), known))
    return sorted(days) if all(map(is_day, days)) else None


def is_day(value: str) -> bool:
    return re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) is not None


def integrate_changes(spark: SparkSession, lake: Lake, *, write_borough_layout: bool = True) -> list[str]:
    """Rewrite the days of the integrated table whose silver partitions are newer; returns them.

    A change of the zones, or no table yet, makes it a whole rewrite.  The layout by borough has no days and is
    rewritten from the first one if anything changed.
    """
    days = changed_days(spark, lake)
    if days is None:
        integrate(spark, lake, write_borough_layout=write_borough_layout)
        return [r["value"] for r in partition_commits(spark, lake.gold(INTEGRATED), "pickup_date").orderBy("value").collect()]
    if days:
        with record_run(spark, lake, "gold", INTEGRATED) as run:
            run.loaded(write_integrated(spark, lake, run.known["run_id"], days))
            if write_borough_layout:
                write_table(read_table(spark, lake.gold(INTEGRATED)), lake.gold(INTEGRATED_BY_BOROUGH), ("pickup_borough",))
    return days


#: For products that are partitioned by it: the partition's value for a day of the integrated table, and the days of values.
SLICES = {
    "pickup_date": (lambda day: day, lambda values: on_days("pickup_date", values)),
    "trip_month": (
        lambda day: month_start(day.try_cast("date")).cast("string"),
        lambda values: month_start("pickup_date").isin([F.lit(v).cast("date") for v in values]),
    ),
}


def refresh_changes(spark: SparkSession, lake: Lake, products: Iterable[Product] = PRODUCTS) -> dict[str, list[str] | None]:
    """Refresh the stale products by their changed partitions; returns those of each, None for a product rewritten whole.

    A product that is partitioned by day or month gets the partitions whose days changed in the integrated table after
    they were written, computed from these days and months alone.  Products over all days are rewritten.
    """
    path, done = lake.gold(INTEGRATED), {}
    integrated = read_table(spark, path)
    version = schema_version(integrated)
    days = partition_commits(spark, path, "pickup_date")
    whole = []
    for product in stale_products(spark, lake, products):
        column = product.partition_by[0] if len(product.partition_by) == 1 else None
        # A schema that moved on changes every row's provenance and columns.
        if column not in SLICES or not table_exists(spark, lake.product(product.name)) or stored_version(spark, lake, product) != version:
            whole.append(product)
            continue
        value_of, rows_of = SLICES[column]
        upstream = days.groupBy(value_of(F.col("value")).alias("value")).agg(F.max("at").alias("at"))
        changed = newer_partitions(upstream, partition_commits(spark, lake.product(product.name), column))
        with record_run(spark, lake, "gold", product.name, version) as run:
            rows = 0
            if changed:
                cube = analytics.demand_cube(integrated.filter(rows_of(changed)))
                rows = write_product_slice(product.build(cube), lake.product(product.name), product.partition_by, version)
            run.loaded(rows)
        done[product.name] = changed
    if whole:
        build_products(spark, lake, force=True, products=whole)
    return done | {p.name: None for p in whole}


def stored_version(spark: SparkSession, lake: Lake, product: Product) -> str | None:
    return read_table(spark, lake.product(product.name)).agg(F.min("_schema_version")).first()[0]


def stale_products(spark: SparkSession, lake: Lake, products: Iterable[Product] = PRODUCTS) -> list[Product]:
    products = list(products)
    commits = last_commits(
        spark, lake, {INTEGRATED: lake.gold(INTEGRATED)} | {p.name: lake.product(p.name) for p in products}
    )
    return [p for p in products if should_refresh(commits[p.name], [commits[INTEGRATED]])]


def build_products(
    spark: SparkSession, lake: Lake, *, force: bool = False, products: Iterable[Product] = PRODUCTS
) -> dict[str, int]:
    """Refresh the stale products (or all of them) and return the rows written per product.

    The integrated table is read once: it is folded to one row per zone and hour, that cube is written to the
    staging area, and every product is derived from it.
    """
    products = list(products)
    due = products if force else stale_products(spark, lake, products)
    if not due:
        return {}
    integrated = read_table(spark, lake.gold(INTEGRATED))
    version = schema_version(integrated)
    cube_path = lake.staging(f"demand_cube-{uuid.uuid4().hex}")
    write_table(analytics.demand_cube(integrated), cube_path)
    cube = read_table(spark, cube_path)

    def refresh(product: Product) -> int:
        with record_run(spark, lake, "gold", product.name, version) as run:
            rows = write_product(product.build(cube), lake.product(product.name), product.partition_by, version)
            run.loaded(rows)
            return rows

    written = side_by_side(spark, {p.name: lambda p=p: refresh(p) for p in due})
    remove_table(spark, cube_path)
    return written
