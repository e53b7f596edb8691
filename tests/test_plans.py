from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from hourgrid.operators import panel, quality
from hourgrid.plans import incidents as plans
from hourgrid.session import materialise, shared_folder
from hourgrid.sources import files
from hourgrid.streaming.hourly import hourly_counts


def square(poly_id, name, x, y, size):
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return poly_id, name, [[{"x": float(a), "y": float(b)} for a, b in ring]]


@pytest.fixture
def dims(spark):
    layer = "poly_id int, name string, rings array<array<struct<x:double,y:double>>>"
    areas = spark.createDataFrame([square(1, "a", 0, 0, 0.5), square(2, "b", 0.5, 0, 0.5)], layer)
    sites = spark.createDataFrame([("s", 0.25, 0.25)], "name string, lat double, lon double")
    hourly = spark.sql("""SELECT explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-20', interval 1 hour)) AS hour_ts""")
    hourly = hourly.withColumns({"temp_f": F.hour("hour_ts") * 2.0 + 30, "precip_in": F.lit(0.02)})
    daily = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-20')) AS date").withColumn("temp_mean_f", F.lit(50.0))
    return plans.Dimensions(areas, sites, {"zone": areas}, {}, hourly, daily)


@pytest.fixture
def raw(spark):
    start = datetime(2024, 1, 2)
    data = []
    for i in range(600):
        at = start + timedelta(minutes=37 * i)
        data.append((f"n{i}", at.strftime("%m/%d/%Y %I:%M:%S %p"), "Larceny-Theft " if i % 4 else "Vandalism",
                     (i % 10) * 0.05 + 0.01, (i % 20) * 0.05 + 0.01, "street" if i % 3 else "shop", "r"))
    data.append(("bad", "nan", "Theft", 0.1, 0.1, "shop", "r"))
    data.append(("nowhere", "01/02/2024 01:00:00 AM", "Theft", None, 0.1, "shop", "r"))
    data.append(data[1])
    return spark.createDataFrame(
        data, "incident_number string, report_date string, offense string, latitude double, longitude double, "
              "location_type string, area_raw string")


def test_whole_chain(raw, dims):
    out = plans.run(raw, dims)
    target = out["target_incidents"]
    assert target.count() == target.select("incident_number").distinct().count() == 450
    assert target.where("area NOT IN ('A', 'B')").count() == 0
    assert {"grid_density_7d", "area_avg_30d", "temp_f", "site_distance_m", "is_holiday", "location_type_count"} <= set(target.columns)
    assert out["sparse"].agg(F.sum("crime_count")).first()[0] == 450
    dense = out["dense"]
    span = quality.time_range(dense).first()
    assert dense.count() == 2 * (span["span_hours"] + 1) == 2 * span["hours"]
    assert dense.agg(F.sum("crime_count")).first()[0] == 450
    assert out["checks"].where("check LIKE 'unique%'").first()["status"] == "PASS"


def test_repair_and_area_rule(spark, dims):
    """Blank areas are filled from the layer, unknown codes go, layer gaps are filled on borders too."""
    df = spark.createDataFrame(
        [(1, None, 0.25, 0.25, "old"), (2, "nan", 0.75, 0.25, None), (3, "zz", 0.25, 0.25, "x"), (4, " b ", 0.25, 0.25, "x"), (5, None, 9.0, 9.0, "x"),
         (6, "A", 0.5, 0.25, None)], "id int, area string, longitude double, latitude double, zone string")
    out = plans.repaired(df, dims)
    assert rows(out, "id", "area", "zone") == [(1, "A", "old"), (2, "B", "b"), (4, "B", "x"), (6, "A", "a")]


def test_watch_flags_reach_the_panel(raw, dims):
    watched = raw.withColumn("event_watch", F.when(F.col("location_type") == "shop", "Day Watch").when(F.col("location_type") == "street", "Night"))
    out = plans.run(watched, dims)
    flags = {"event_watch_day_watch", "event_watch_night", "near_s"}
    assert flags <= set(out["sparse"].columns) and flags <= set(out["target"].columns) and "event_watch" not in out["sparse"].columns
    assert out["sparse"].where("event_watch_day_watch NOT IN (0, 1)").count() == 0
    assert out["sparse"].where("event_watch_day_watch = 1").count() > 0


def test_wide_rows_are_written_once(raw, dims):
    """Target incidents are picked from the table of the enriched ones; near flags are read off the label."""
    out = plans.run(raw, dims)
    target, everything = out["target_incidents"], out["all_incidents"]
    files = everything.inputFiles()
    assert files and set(target.inputFiles()) == set(files)
    assert "near_s" not in everything.sparkSession.read.parquet(*files).columns
    assert everything.where("near_s != int(site_label = 's')").count() == 0 and target.where("near_s = 1").count() > 0
    twice = plans.target_incidents(everything.unionByName(everything), key="incident_number")
    assert twice.count() == target.count() and rows(twice, "incident_number", "near_s") == rows(target, "incident_number", "near_s")


def test_flags_by_sums_are_modes(raw, dims):
    watched = raw.withColumn("event_watch", F.when(F.col("location_type") == "shop", "Day Watch").when(F.col("location_type") == "street", "Night"))
    target = materialise(plans.target_incidents(plans.enrich(plans.clean(watched), dims)))
    flags = ["event_watch_day_watch", "event_watch_night", "near_s"]
    modes, sums = plans.panels(target)["sparse"], plans.panels(target, flags=flags)["sparse"]
    assert sums.schema == modes.schema and rows(sums, "area", "hour_ts", *flags) == rows(modes, "area", "hour_ts", *flags)
    given = target.sparkSession.createDataFrame([("a", 0), ("a", 1), ("b", 1), ("b", None), ("c", None), ("d", 0), ("d", 1), ("d", 1)], "k string, f int")
    assert rows(panel.aggregate(given, ["k"], {"f": "flag"}), "k", "f") == rows(panel.aggregate(given, ["k"], {"f": "mode"}), "k", "f")


def test_panel_orders_differ(raw, dims):
    target = materialise(plans.target_incidents(plans.enrich(plans.clean(raw), dims)))
    first = plans.panels(target)
    reference = plans.panels(target, order="reference")
    assert first["target"].count() == reference["target"].count() == reference["sparse"].count()
    assert first["sparse"].count() > reference["sparse"].count()


def test_enrichment_keeps_located_rows(raw, dims):
    cleaned = plans.clean(raw)
    located = cleaned.dropna(subset=["latitude", "longitude"]).count()
    log = quality.StepLog()
    out = plans.enrich(cleaned, dims, log=log)
    assert out.count() == located == 601


def test_quoted_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,kind\n1,"say ""hi"", ok",q\n2,"two\nlines",r\n3,back\\slash,s\n')
    for i in range(30):
        (tmp_path / f"more{i}.csv").write_text(f"id,text\n{100 + i},plain\n")
    (tmp_path / "empty.csv").write_text("")
    got = {r["id"]: (r["text"], r["kind"]) for r in files.read_csv_folder(spark, str(tmp_path)).collect()}
    assert len(got) == 33 and got["1"] == ('say "hi", ok', "q") and got["2"] == ("two\nlines", "r") and got["3"] == ("back\\slash", "s")
    assert got["129"] == ("plain", None)
    files.write_csv(spark.createDataFrame([('a "b", c', "x\ny")], "p string, q string"), str(tmp_path / "out"))
    assert [tuple(r) for r in files.read_any(spark, str(tmp_path / "out")).collect()] == [('a "b", c', "x\ny")]


def test_csv_folder_of_two_widths(spark, tmp_path):
    (tmp_path / "b.csv").write_text("IncidentNumber,Offense\n2,second\n1,again\n")
    (tmp_path / "a.csv").write_text("Offense,IncidentNumber,Extra Col\nfirst,1,x\n")
    df = files.read_csv_folder(spark, str(tmp_path))
    assert {"incident_number", "offense", "extra_col"} <= set(df.columns)
    assert rows(files.combine_incidents(df), "incident_number", "offense", "extra_col") == [("1", "first", "x"), ("2", "second", None)]
    with pytest.raises(FileNotFoundError):
        files.read_csv_folder(spark, str(tmp_path / ".."))


def test_headers_are_read_from_the_start_of_a_file(spark, tmp_path):
    texts = {"a.csv": "id,kind\n1,x\n", "b.csv": "id,kind\r\n2,y\r\n", "c.csv": "id\n" + "7\n" * 50_000, "d.csv": "", "e.csv": "id,é"}
    for name, content in texts.items():
        (tmp_path / name).write_bytes(content.encode())
    found = files.csv_headers(spark, files.list_files(spark, str(tmp_path), ".csv"))
    assert {h: [f.rsplit("/", 1)[1] for f in members] for h, members in found.items()} == {
        "id": ["c.csv"], "id,kind": ["a.csv", "b.csv"], "id,é": ["e.csv"]}
    counts = {r["file"].rsplit("/", 1)[1]: (r["rows"], r["columns"]) for r in files.tree_counts(spark, str(tmp_path)).collect()}
    assert counts == {"a.csv": (1, 2), "b.csv": (1, 2), "c.csv": (50_000, 1), "d.csv": (0, 0), "e.csv": (0, 2)}


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_any(spark, str(tmp_path / "none"))


def test_dense_writer_makes_one_folder_per_area(spark, hours, tmp_path):
    df = hours([(a, h, h) for a in "AB" for h in range(0, 1500, 100)])
    files.write_dense_panel(df, str(tmp_path / "d"))
    assert {p.name for p in (tmp_path / "d").iterdir() if p.is_dir()} == {"area=A", "area=B"}
    back = files.read_panel(spark, str(tmp_path / "d"))
    assert rows(back, "area", "hour_ts", "n") == rows(df)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/hourgrid-")


def test_scan_reads_only_what_is_needed(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.chr(65 + F.col("user_id") % 25).alias("area"), F.col("ts").alias("report_date"), "value", "props")
    text = plan(panel.hourly_counts(events.where(F.col("report_date") < F.lit("2024-01-08").cast("timestamp_ntz"))))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in text
    assert text.count("HashAggregate") == 2


def test_streamed_counts_equal_batch(spark, tmp_path):
    start = datetime(2024, 1, 1)
    data = [(chr(65 + i % 3), start + timedelta(minutes=11 * i)) for i in range(300)]
    data.append(("A", start + timedelta(days=9)))
    df = spark.createDataFrame(data, "area string, report_date timestamp_ntz")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (hourly_counts(stream).writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out"))
             .trigger(availableNow=True).start())
    assert query.awaitTermination(120)
    batch = panel.hourly_counts(df).where(F.col("hour_ts") < F.lit(start + timedelta(days=8)))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)


def test_counts_of_a_file_tree(spark, tmp_path):
    from hourgrid.sources import files

    (tmp_path / "in" / "a b").mkdir(parents=True)
    (tmp_path / "in" / "one.csv").write_text('x,y\n1,"two\nlines"\n3,4\n')
    (tmp_path / "in" / "a b" / "two.csv").write_text("x,y,z\n1,2,3\n")
    (tmp_path / "in" / "a b" / "none.csv").write_text("x,y,z\n")
    (tmp_path / "in" / "a b" / "empty.csv").write_text("")
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "in" / "p" / "q"))
    spark.range(0).selectExpr("id", "'t' AS t").coalesce(1).write.parquet(str(tmp_path / "in" / "p" / "none"))
    got = files.tree_counts(spark, str(tmp_path / "in")).collect()
    made = sorted((r["file"].rsplit("/", 1)[1] if r["file"].endswith("csv") else "parquet", r["rows"], r["columns"]) for r in got)
    assert made == [("empty.csv", 0, 0), ("none.csv", 0, 3), ("one.csv", 2, 2), ("parquet", 0, 2), ("parquet", 7, 1), ("two.csv", 1, 3)]


def test_unique_targets_are_neither_sorted_nor_moved(spark):
    """Only where an incident has a second row are the wide rows ordered; then the first one stays."""
    df = spark.createDataFrame(
        [(1, "theft", datetime(2024, 1, 2)), (2, "arson", datetime(2024, 1, 2)), (3, "Theft", datetime(2024, 1, 3))],
        "incident_number int, offense string, report_date timestamp_ntz")
    once = plans.target_incidents(df)
    assert "Window" not in plan(once) and "Exchange" not in plan(once)
    assert rows(once, "incident_number") == [(1,), (3,)]
    twice = plans.target_incidents(df.unionByName(df.withColumn("report_date", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))))
    assert rows(twice, "incident_number", "report_date") == [(1, datetime(2024, 1, 1)), (3, datetime(2024, 1, 1))]
