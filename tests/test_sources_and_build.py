import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import trips_df
from zonecast.plans import build as bd
from zonecast.plans import reports as rp
from zonecast.sources import driver_tables as dt
from zonecast.sources.sinks import write_parquet
from zonecast.sources.trips import read_monthly_trips, read_trip_window
from zonecast.sources.zones import load_zone_lookup


def test_monthly_files_and_window_read(spark, tmp_dir):
    t0 = datetime(2024, 1, 31, 23, 30)
    rows = [(t0, t0 + timedelta(minutes=5), 161, 1.0), (t0 + timedelta(hours=1), t0 + timedelta(hours=1, minutes=5), 161, 1.0)]
    frame = trips_df(spark, rows)
    for label, part in (("2024-01", frame.limit(1)), ("2024-02", frame.orderBy(F.desc("tpep_pickup_datetime")).limit(1))):
        import pyarrow as pa
        import pyarrow.parquet as pq

        table = pa.Table.from_pandas(part.toPandas(), preserve_index=False)
        pq.write_table(table, os.path.join(tmp_dir, f"yellow_tripdata_{label}.parquet"), coerce_timestamps="us")
    paths = [os.path.join(tmp_dir, f"yellow_tripdata_{m}.parquet") for m in ("2024-01", "2024-02")]
    tagged = {r.source_month for r in read_monthly_trips(spark, paths).collect()}
    assert tagged == {"2024-01", "2024-02"}
    window = read_trip_window(spark, paths, start_time="2024-02-01 00:00:00", end_time="2024-03-01 00:00:00")
    assert window.count() == 1
    assert "PushedFilters: [IsNotNull(tpep_pickup_datetime), GreaterThanOrEqual" in window._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no trip was picked up"):
        read_trip_window(spark, paths, start_time="2025-01-01 00:00:00", end_time="2025-02-01 00:00:00")


def test_stray_rows_of_month_files_are_not_counted(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    def write(label, days, width):
        t = [datetime(2024, m, d, 5) for m, d in days]
        pq.write_table(pa.table({
            "tpep_pickup_datetime": pa.array(t, pa.timestamp("us")), "tpep_dropoff_datetime": pa.array([x.replace(hour=6) for x in t], pa.timestamp("us")),
            "PULocationID": pa.array([7] * len(t), width), "DOLocationID": pa.array([8] * len(t), width),
            "trip_distance": pa.array([1.0] * len(t)), "total_amount": pa.array([9.0] * len(t)),
        }), os.path.join(tmp_dir, f"yellow_tripdata_{label}.parquet"))

    write("2024-01", [(1, 3), (2, 2)], pa.int32())  # the second row strays into February
    write("2024-02", [(2, 9)], pa.int64())
    trips = read_monthly_trips(spark, [os.path.join(tmp_dir, f"yellow_tripdata_2024-0{m}.parquet") for m in (1, 2)])
    mart, manifest = bd.build_manifest(trips, "2024-01", "2024-02")
    assert {r.month: r.input_rows for r in manifest.collect()} == {"2024-01": 1, "2024-02": 1}
    assert mart.agg(F.sum("demand")).first()[0] == 2
    with pytest.raises(ValueError):
        bd.build_manifest(trips, "2024-02", "2024-01")


def test_zone_lookup_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens, Jamaica Bay ,\n")
    rows = load_zone_lookup(spark, path).orderBy("zone_id").collect()
    assert [r.zone_id for r in rows] == [1, 2]
    assert rows[1].zone_name == "Jamaica Bay" and rows[1].service_zone == "Unknown"


def test_build_dataset_range_writes_mart_and_manifest(spark, tmp_dir):
    trips = dt.trips(spark, "/root/testdata/sf0.001")
    manifest = bd.build_dataset_range(trips, "2024-01", "2024-01", tmp_dir).collect()
    assert len(manifest) == 1 and manifest[0].month == "2024-01"
    assert manifest[0].null_pickup_rows == 0  # a missing pickup never enters a month window
    mart = spark.read.parquet(os.path.join(tmp_dir, "demand"))
    assert mart.count() == manifest[0].merged_rows
    assert {r.month for r in mart.select("month").distinct().collect()} == {"2024-01"}
    lines = [json.loads(x) for f in os.listdir(os.path.join(tmp_dir, "manifest")) if f.endswith(".json")
             for x in open(os.path.join(tmp_dir, "manifest", f))]
    assert lines[0]["valid_rows"] == manifest[0].valid_rows


def test_aggregate_file_and_eda_report(spark, tmp_dir):
    trips = dt.trips(spark, "/root/testdata/sf0.001")
    bd.aggregate_file(trips, tmp_dir, start_time=datetime(2024, 1, 1), end_time=datetime(2024, 1, 15))
    mart = spark.read.parquet(os.path.join(tmp_dir, "demand"))
    quality = spark.read.json(os.path.join(tmp_dir, "quality")).first()
    assert mart.agg(F.sum("demand")).first()[0] == quality.valid_rows
    report = rp.eda_report(mart, top_n=3).first()
    assert report.overview.rows == mart.count()
    assert [r.hour for r in report.hourly_profile] == list(range(24))
    assert len(report.top_zones) == 3
    assert report.top_zones[0].total_demand >= report.top_zones[-1].total_demand
    rp.write_eda_report(mart, tmp_dir, top_n=3)
    assert os.path.isdir(os.path.join(tmp_dir, "eda_report"))
    write_parquet(mart, os.path.join(tmp_dir, "copy"))
    assert spark.read.parquet(os.path.join(tmp_dir, "copy")).count() == mart.count()


# ---- one scan, month outputs, updates ----------------------------------------------
def raw_scans(frame, folder):
    """File scans of ``folder`` in the executed plan."""
    return frame._jdf.queryExecution().executedPlan().toString().count(f"InMemoryFileIndex(1 paths)[file:{folder}")


def month_files(spark, folder):
    """Parquet copies of the trip view, so that scans can be told apart."""
    trips = dt.trips(spark, "/root/testdata/sf0.001")
    shifted = F.when(F.col("PULocationID") % 3 == 0, F.expr("INTERVAL 31 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    moved = trips.withColumns({c: F.col(c) + shifted for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    moved.write.parquet(folder)
    return spark.read.parquet(folder)


def test_builds_scan_the_trips_once(spark, tmp_dir, monkeypatch):
    trips = month_files(spark, os.path.join(tmp_dir, "trips"))
    written = []
    real = bd.materialize
    monkeypatch.setattr(bd, "materialize", lambda frame, name: written.append(raw_scans(frame, os.path.join(tmp_dir, "trips"))) or real(frame, name=name))
    mart, manifest = bd.build_manifest(trips, "2024-01", "2024-02")
    assert written == [1] and raw_scans(mart, os.path.join(tmp_dir, "trips")) == raw_scans(manifest, os.path.join(tmp_dir, "trips")) == 0
    bd.aggregate_file(trips, os.path.join(tmp_dir, "one"))
    assert written == [1, 1]


def test_audit_agrees_with_separate_passes(spark, tmp_dir):
    from zonecast.operators.mart import aggregate_hourly_demand
    from zonecast.operators.quality import quality_report

    trips = month_files(spark, os.path.join(tmp_dir, "trips"))
    tagged = bd.tag_months(trips, "2024-01", "2024-02")
    audit = bd.audit_trips(tagged, by=["month"])
    by = lambda frame: sorted(tuple(r) for r in frame.collect())
    assert by(bd.audit_report(audit, by=["month"])) == by(quality_report(tagged, by=["month"]))
    assert by(bd.audit_report(bd.audit_trips(trips))) == by(quality_report(trips))
    assert by(bd.audit_report(bd.audit_trips(trips.limit(0)))) == by(quality_report(trips.limit(0)))
    columns = ["timestamp", "zone_id", "demand"]
    assert by(bd.build_manifest(trips, "2024-01", "2024-02")[0].select(*columns)) == by(aggregate_hourly_demand(tagged.drop("month")).select(*columns))


def snapshot(spark, folder):
    mart = sorted(tuple(r) for r in spark.read.parquet(os.path.join(folder, "demand")).select("timestamp", "zone_id", "demand", "month").collect())
    months = sorted(tuple(r) for r in bd.read_months(spark, folder).collect())
    names = [c for c in bd.read_manifest(spark, folder).columns if not c.endswith("_output")]
    return mart, months, sorted(tuple(r) for r in bd.read_manifest(spark, folder).select(*names).collect())


def files_of(folder):
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder)}


def test_updated_months_equal_a_full_build(spark, tmp_dir):
    trips = month_files(spark, os.path.join(tmp_dir, "trips"))
    out, full = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "full")
    manifest = bd.build_dataset_range(trips, "2024-01", "2024-02", out).orderBy("month").collect()
    assert [os.path.basename(r.monthly_output) for r in manifest] == ["month=2024-01", "month=2024-02"]
    assert all(os.path.isdir(r.monthly_output) and r.merged_output == os.path.join(out, "demand") for r in manifest)
    january = files_of(bd.month_path(out, "2024-01"))
    # February loses some trips, and March comes in
    pickup = F.col("tpep_pickup_datetime")
    late = F.when((pickup >= "2024-02-20") & (F.col("DOLocationID") % 2 == 0), F.expr("INTERVAL 20 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    changed = trips.withColumns({c: F.col(c) + late for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    bd.update_months(changed, ["2024-03", "2024-02"], out)
    bd.build_dataset_range(changed, "2024-01", "2024-03", full)
    assert snapshot(spark, out) == snapshot(spark, full)
    assert files_of(bd.month_path(out, "2024-01")) == january
    # a month whose trips are all gone
    empty = changed.filter((pickup < "2024-02-01") | (pickup >= "2024-03-01"))
    bd.update_months(empty, ["2024-02"], out)
    bd.build_dataset_range(empty, "2024-01", "2024-03", full)
    assert snapshot(spark, out)[:2] == snapshot(spark, full)[:2]
    gone = {r.month: r for r in bd.read_manifest(spark, out).collect()}["2024-02"]
    assert gone.input_rows == 0 and gone.monthly_output is None and gone.valid_share == 0.0
    with pytest.raises(ValueError):
        bd.update_months(trips, [], out)


def test_files_of_other_months_are_not_opened(spark, tmp_dir):
    trips = dt.trips(spark, "/root/testdata/sf0.001").select(*[F.col(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "total_amount")])
    table = trips.toArrow()
    import pyarrow.parquet as pq

    for label in ("2023-12", "2024-01", "2024-02", "2024-03"):
        pq.write_table(table, os.path.join(tmp_dir, f"yellow_tripdata_{label}.parquet"), coerce_timestamps="us")
    with open(os.path.join(tmp_dir, "yellow_tripdata_2024-05.parquet"), "w") as broken:
        broken.write("no parquet at all")
    paths = [os.path.join(tmp_dir, f) for f in sorted(os.listdir(tmp_dir)) if f.endswith(".parquet")]
    read = read_monthly_trips(spark, paths, months=["2024-01", "2024-02"])
    assert {r.source_month for r in read.select("source_month").distinct().collect()} == {"2024-01", "2024-02"}
    plan = read._jdf.queryExecution().executedPlan()
    read.count()
    scan = plan.collectLeaves().apply(0)
    scan.executeColumnar() if scan.supportsColumnar() else scan.execute()
    assert scan.metrics().apply("numFiles").value() == 2
    manifest = bd.build_from_files(spark, paths, "2024-01", "2024-02", os.path.join(tmp_dir, "out"))
    assert [r.month for r in manifest.collect()] == ["2024-01"]  # the other file's rows lie in January


def test_zone_csv_is_bound_by_name(spark, tmp_dir):
    from zonecast.sources.zones import read_zone_lookup_csv

    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write("Borough,extra,LocationID,service_zone,Zone\nQueens,x, 7 ,Boro Zone,Astoria\n,y,8,,\n")
    rows = read_zone_lookup_csv(spark, path).collect()
    assert [tuple(r) for r in rows] == [(7, "Queens", "Astoria", "Boro Zone"), (8, None, None, None)]
    with open(path, "w") as fh:
        fh.write("Borough,Zone,service_zone\na,b,c\n")
    with pytest.raises(ValueError, match="LocationID"):
        read_zone_lookup_csv(spark, path)
    with open(path, "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\nseven,a,b,c\n")
    with pytest.raises(Exception, match="seven"):
        read_zone_lookup_csv(spark, path).collect()


def test_table_readers_check_what_they_read(spark, tmp_dir):
    from zonecast.sources import tables as tb

    path = os.path.join(tmp_dir, "t")
    rows = [(datetime(2024, 1, 1, h), 3, h, h / 2, h * 1.0, "x") for h in range(4)]
    frame = spark.createDataFrame(rows, "timestamp timestamp_ntz, zone_id long, demand long, demand_lag_1h double, prediction double, note string")
    frame.withColumn("actual", F.col("demand").cast("int")).write.parquet(path)
    demand = tb.read_demand(spark, path)
    assert [f.dataType.simpleString() for f in demand.schema] == ["timestamp_ntz", "smallint", "int"] and demand.count() == 4
    features = tb.read_features(spark, path, feature_columns=["demand_lag_1h", "demand"])
    assert features.schema["demand"].dataType.simpleString() == "bigint" and "note" in features.columns
    window = tb.read_scored_window(spark, [path], feature_columns=["demand_lag_1h"])
    assert window.columns == ["actual", "prediction", "demand_lag_1h"] and window.agg(F.sum("actual")).first()[0] == 6.0
    assert "note" not in window._jdf.queryExecution().executedPlan().toString()
    for call in (lambda: tb.read_features(spark, path, feature_columns=["note"]), lambda: tb.read_scored_window(spark, path, actual_column="target"), lambda: tb.read_features(spark, path, feature_columns=["nowhere"])):
        with pytest.raises(ValueError):
            call()


# ---- reports -----------------------------------------------------------------------
def read_report(path):
    return [json.loads(x) for f in sorted(os.listdir(path)) if f.endswith(".json") for x in open(os.path.join(path, f))]


def weekly_mart(spark, hours=24 * 30):
    from helpers import demand_df

    start = datetime(2024, 3, 1)
    level = lambda i, z: 4 + z % 5 + (6 if 8 <= i % 24 < 20 else 0) + (i * 7 + z) % 3
    return demand_df(spark, [(start + timedelta(hours=i), z, level(i, z)) for i in range(hours) for z in (4, 12)])


FOLDS = {"horizon_hours": 6, "train_days": 15, "validation_days": 4, "step_days": 4}


def test_benchmark_report(spark, tmp_dir):
    rp.write_benchmark_report(weekly_mart(spark), tmp_dir, **FOLDS)
    (report,) = read_report(os.path.join(tmp_dir, "benchmark"))
    assert report["horizon_hours"] == 6 and [f["fold"] for f in report["folds"]] == list(range(1, len(report["folds"]) + 1))
    for name, mean in report["summary"].items():
        assert mean == pytest.approx(sum(f[name] for f in report["folds"]) / len(report["folds"]))


def test_training_and_explanation_reports(spark, tmp_dir):
    from zonecast.operators.features import build_features
    from zonecast.plans.models import load_model_bundle

    bundle, mart = os.path.join(tmp_dir, "bundle"), weekly_mart(spark)
    for version in (1, 2):
        report = rp.train_and_report(mart, bundle, tmp_dir, **FOLDS).first()
        assert report.model_version == version and report.model_dir == bundle
    model = load_model_bundle(bundle)
    assert list(report.feature_names) == list(model.feature_names) and model.horizon_hours == report.horizon_hours == 6
    assert report.summary.wape == pytest.approx(sum(f.wape for f in report.folds) / len(report.folds)) and len(report.folds) >= 2
    features = build_features(mart)
    rp.write_explanation_report(bundle, features, tmp_dir, top_n=5)
    (told,) = read_report(os.path.join(tmp_dir, "explanation"))
    sizes = [f["mean_abs_contribution"] for f in told["features"]]
    assert told["horizon_hours"] == 6 and len(sizes) == 5 and sizes == sorted(sizes, reverse=True)
    assert told["rows_explained"] == features.filter("demand_lag_168h IS NOT NULL").count()
    with pytest.raises(ValueError):
        rp.explanation_report(model, features, top_n=0)


def test_monitoring_report_file(spark, tmp_dir):
    rows = [(float(i % 9), float(i % 4), 10.0 + i % 5, 10.0) for i in range(200)]
    reference = spark.createDataFrame(rows, "a double, b double, actual double, prediction double")
    current = reference.withColumn("b", F.col("b") + 30)
    rp.write_monitoring_report(reference, current, tmp_dir, feature_names=["a", "b"])
    (report,) = read_report(os.path.join(tmp_dir, "monitoring"))
    assert report["overall_status"] == "critical" and [d["feature"] for d in report["drift"]] == ["b", "a"]
    assert [d["status"] for d in report["drift"]] == ["drift", "stable"] and report["drift_features"] == 1
    assert report["max_psi"] == report["drift"][0]["psi"] and report["current_observations"] == 200
