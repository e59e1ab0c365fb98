"""Features from raw events at sensor rates: the chunked operators against plain
windows without a partition, on one machine.

    python scale_bench.py <scratch folder> [months] [chunked|plain|keyed ...]

Every event of $BENCH_SF_DIR becomes 20 seconds of driving, with ten IMU, two
encoder readings and one GPS fix each, and the month of events is repeated. The
expanded events are written to the scratch folder once."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import Window
from pyspark.sql import functions as F

from odotrack.operators.bronze import bronze_encoder, bronze_gps, bronze_imu
from odotrack.operators.kinematics import align, gates
from odotrack.operators.quality import expect_all_or_drop
from odotrack.operators.resample import encoder_aggregates, gps_aggregates, imu_aggregates
from odotrack.plans.medallion import features_from_raw
from odotrack.session import get_spark

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def expand(events, months):
    month = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    events = events.withColumn("month", month)
    start = F.unix_micros(F.date_trunc("second", F.col("ts").cast("timestamp"))) + F.col("month") * 2_592_000_000_000
    reading = F.explode(F.sequence(F.lit(0), F.lit(20 * 13 - 1)))
    rows = events.select("event_id", "user_id", "value", start.alias("start"), reading.alias("n"))
    second, slot = F.floor(F.col("n") / 13), F.col("n") % 13
    sensor = F.when(slot < 10, "IMU").when(slot < 12, "ENCODER").otherwise("GPS")
    noise = F.hash("event_id", "n") % 1000 / 1000
    data = F.struct(
        F.when(slot < 10, noise * 9).alias("accel_x"),
        F.when(slot < 10, noise * -4).alias("accel_y"),
        F.when(slot < 10, noise * 20).alias("gyro_z"),
        F.when((slot >= 10) & (slot < 12), (F.col("value") * 10 + noise * 100).cast("long")).alias("ticks"),
        F.when(slot == 12, 40 + F.col("n") / 1e6).alias("lat"),
        F.when(slot == 12, -74 + noise / 1e4).alias("lon"),
    )
    return rows.select(
        (F.col("user_id") % 8).alias("robot_id"),
        sensor.alias("sensor"),
        F.timestamp_micros((F.col("start") + (second + slot / 13) * 1_000_000).cast("long")).alias("ts"),
        data.alias("data"),
    )


def chunked(raw):
    return features_from_raw(raw)


def keyed(raw):
    return features_from_raw(raw, ["robot_id"])


def seconds_of(df, aggs):
    grouped = df.groupBy(F.window("timestamp", "1 second")).agg(*aggs)
    return grouped.select(F.col("window.start").alias("timestamp"), "*").drop("window")


def plain(raw):
    """Three resamples by window struct, two joins, then windows over everything."""
    aligned = align(
        seconds_of(bronze_imu(raw), imu_aggregates(F.col("accel_x"), F.col("accel_y"), F.col("gyro_z"))),
        seconds_of(bronze_encoder(raw), encoder_aggregates(F.col("ticks"))),
        seconds_of(bronze_gps(raw), gps_aggregates(F.col("latitude"), F.col("longitude"))),
    )
    everything = Window.orderBy("timestamp")

    def wait():
        return F.coalesce(
            (F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(everything))) / 1e6, F.lit(0.0)
        )

    v = F.col("total_ticks_per_sec") * 0.001745
    moving = aligned.withColumn("velocity_mps", v).withColumn("dt", wait())
    change = (F.col("velocity_mps") - F.lag("velocity_mps").over(everything)) / F.col("dt")
    master = moving.withColumn("acceleration_mps2", F.when(F.col("dt") > 0, change).otherwise(0.0)).drop("dt")
    df = expect_all_or_drop(master, gates()).withColumn("dt", wait())
    opens = F.when(F.lag("timestamp").over(everything).isNull() | (F.col("dt") > 5), 1).otherwise(0)
    df = df.withColumn("opens", opens).withColumn("session_id", F.sum("opens").over(everything))
    here = Window.partitionBy("session_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("h", F.sum(F.radians("avg_gyro_z") * F.col("dt")).over(here))
    path = {f: F.col("velocity_mps") * getattr(F, f)("h") * F.col("dt") for f in ("cos", "sin")}
    df = df.withColumns(
        {
            "feature_estimated_path_x": F.sum(path["cos"]).over(here),
            "feature_estimated_path_y": F.sum(path["sin"]).over(here),
            "feature_actual_path_x": (F.col("latitude") - F.first("latitude").over(here)) * 111000.0,
            "feature_actual_path_y": (F.col("longitude") - F.first("longitude").over(here)) * 77700.0,
        }
    )
    return df.withColumn(
        "target_trajectory_drift_meters",
        F.hypot(
            F.col("feature_actual_path_x") - F.col("feature_estimated_path_x"),
            F.col("feature_actual_path_y") - F.col("feature_estimated_path_y"),
        ),
    )


def main() -> None:
    scratch = Path(sys.argv[1])
    months = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = get_spark(
        "scale",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": str(4 * int(CPUS)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch / f"raw-{months}"
    if not path.exists():
        expand(spark.read.parquet(f"{FOLDER}/events.parquet").repartition(16), months).write.parquet(str(path))
    raw = spark.read.parquet(str(path))
    result = {"raw_rows": raw.count()}
    runs = {"chunked": chunked, "plain": plain, "keyed": keyed}
    for name in sys.argv[3:] or ["chunked", "plain", "chunked", "plain"]:
        started = time.perf_counter()
        features = runs[name](raw).agg(
            F.count("*").alias("rows"),
            F.max("session_id").alias("sessions"),
            F.round(F.sum("target_trajectory_drift_meters"), 1).alias("drift"),
        )
        row = features.first()
        result[name] = {"sec": round(time.perf_counter() - started, 2), **row.asDict()}
        print(name, result[name], flush=True)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
