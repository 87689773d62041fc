"""Flight lines recovered per scan source: aggregations of plain numbers with map-side combine, no sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut


def source_stats(points: DataFrame) -> DataFrame:
    """Count and ranges of angle and time of each source; angle bounds start at 90 and -90."""
    return points.groupBy("source_id").agg(
        F.count("*").alias("n"),
        F.least(F.lit(90), F.min("scan_angle")).alias("min_angle"),
        F.greatest(F.lit(-90), F.max("scan_angle")).alias("max_angle"),
        F.min("gps_time").alias("min_gps"),
        F.max("gps_time").alias("max_gps"),
    )


def representative_angle(stats: DataFrame) -> DataFrame:
    """repr_angle: the middle of a narrow range, else the angle nearest nadir 5 degrees inside the edges."""
    low, high = F.col("min_angle") + 5, F.col("max_angle") - 5
    wide = F.when((low <= 0) & (high >= 0), 0).when(low >= 0, low).otherwise(high)
    return stats.withColumn("repr_angle", F.when(F.col("max_angle") - F.col("min_angle") <= 10, F.expr("(max_angle + min_angle) div 2")).otherwise(wide).cast("int"))


def flight_lines(points: DataFrame, scale: tuple[float, float] = (1.0, 1.0), angle_tolerance: int = 2) -> DataFrame:
    """(source_id, n, is_valid, theta_along, theta_across): azimuths along and across each flight line.

    Along: from the first to the last point (earliest row of equals) near the representative
    angle; across: from the least to the greatest angle near the middle of the time range.
    Invalid, with null azimuths: an end is missing, both coincide, or the azimuths are
    nearly parallel. The few statistics rows are joined to the points by source.
    """
    stats = representative_angle(source_stats(points))
    joined = points.join(stats, "source_id")
    along = F.abs(F.col("scan_angle") - F.col("repr_angle")) <= angle_tolerance
    middle, tolerance = (F.col("max_gps") + F.col("min_gps")) / F.lit(2.0), (F.col("max_gps") - F.col("min_gps")) / F.lit(100.0)
    across = F.abs(F.col("gps_time") - middle) <= tolerance
    angle = F.col("scan_angle")
    # Least and greatest keys of the four ends first, then the few points that have them, then the first row of equals.
    roles = {
        "p0": (along, "gps_time", F.min),
        "p1": (along, "gps_time", F.max),
        "p2": (across & (angle < 90), "scan_angle", F.min),
        "p3": (across & (angle > -90), "scan_angle", F.max),
    }
    keys = joined.groupBy("source_id").agg(F.max("n").alias("n"), *[f(F.when(c, F.col(k))).alias(f"{p}_key") for p, (c, k, f) in roles.items()])
    keys = cut(keys)
    met = joined.drop("n").join(keys, "source_id")
    has = {p: F.coalesce(c & (F.col(k) == F.col(f"{p}_key")), F.lit(False)) for p, (c, k, _) in roles.items()}
    met = cut(met.select("source_id", "pid", "x", "y", *[h.alias(p) for p, h in has.items()]).filter("p0 OR p1 OR p2 OR p3"))
    chosen = met.groupBy("source_id").agg(*[F.min(F.when(F.col(p), F.col("pid"))).alias(f"{p}_pid") for p in roles])
    ends = met.join(chosen, "source_id").groupBy("source_id").agg(*[F.max(F.when(F.col(p) & (F.col("pid") == F.col(f"{p}_pid")), F.col(c))).alias(f"{p}_{c}") for p in roles for c in "xy"])
    ends = keys.select("source_id", "n").join(ends, "source_id", "left")
    ends = ends.select("source_id", "n", *[F.when(F.col(f"{p}_x").isNotNull(), F.struct(F.col(f"{p}_x").alias("x"), F.col(f"{p}_y").alias("y"))).alias(p) for p in roles])

    def azimuth(a: str, b: str):
        return F.atan2((F.col(f"{b}.y") - F.col(f"{a}.y")) * F.lit(scale[1]), (F.col(f"{b}.x") - F.col(f"{a}.x")) * F.lit(scale[0]))

    ends = ends.withColumns({"al": azimuth("p0", "p1"), "ac": azimuth("p2", "p3")})
    check = F.cos("al") * F.sin("ac") - F.cos("ac") * F.sin("al")
    complete = F.col("p0").isNotNull() & F.col("p1").isNotNull() & F.col("p2").isNotNull() & F.col("p3").isNotNull()
    valid = F.coalesce(complete & (F.col("p0") != F.col("p1")) & (F.col("p2") != F.col("p3")) & (F.abs(check) >= 0.5), F.lit(False))
    return ends.select("source_id", "n", valid.alias("is_valid"), F.when(valid, F.col("al")).alias("theta_along"), F.when(valid, F.col("ac")).alias("theta_across"))


def with_flight_lines(points: DataFrame, lines: DataFrame) -> DataFrame:
    """Points with their source's flight line; Spark broadcasts the lines when they are small."""
    return points.join(lines.drop("n"), "source_id", "left")
