"""The flows end to end on a small incident file."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from sievework import sources
from sievework.operators import audit, clean, integrity, summaries, validate
from sievework.plans import catalog, cleaning, exploration, features, ingest, presets, publishing
from sievework.plans.spec import FeatureSpec
from sievework.sources import read_json_document


def incident_lines():
    lines = [",".join(presets.INCIDENT_COLUMNS)]
    for i in range(400):
        hour = i % 24
        kind = ["THEFT", " battery ", "NARCOTICS"][hour * 3 // 24]
        stamp = dt.datetime(2020, 1 + i % 12, 1 + i % 28, hour).strftime("%m/%d/%Y %I:%M:%S %p")
        lat, lon = f"{41.7 + i % 50 / 1000:.3f}", f"{-87.7 + i % 30 / 1000:.3f}"
        lines.append(
            f'{i},HX{i},{stamp},0XX W MAIN ST,0820,{kind},SIMPLE,{"STREET" if i % 2 else ""},'
            f'{"true" if i % 4 == 0 else "FALSE"},false,111,{i % 20}.0,{i % 50 if i % 9 else ""},{i % 11},06,1,2,2020,{stamp},'
            f'{lat},{lon},"({lat}, {lon})"'
        )
    lines.append(lines[5])
    lines.append(lines[6].replace("THEFT", "ARSON").replace("5,HX5", "900,HX5"))
    lines.append(lines[7].replace("HX6", "HY1").replace(lines[7].split(",")[2], "not a date"))
    lines.append("901,HY2,01/01/2020 01:00:00 AM,B,1,RARE ONE,S,ALLEY,true,true,1,1,1,1,1,1,1,2020,,41.71,-87.69,x")
    lines.append("902,HY3,01/01/2020 01:00:00 AM,B,1,THEFT,S,ALLEY,true,true,1,1,1,1,1,1,1,2020,,10.0,-87.69,x")
    lines.append("903,HY4,01/01/2020 01:00:00 AM,B,1,THEFT,S,ALLEY,true,true,1,1,1,1,1,1,1,2020,,,,x")
    lines.append(lines[8] + ",one field too many")
    return lines


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    source = root / "incidents.csv"
    source.write_text("\n".join(incident_lines()) + "\n")
    dataset = ingest.Dataset(
        "incidents", "v1.0", str(source), str(root / "raw"), str(root / "processed"), str(root / "catalog")
    )
    landed = ingest.run_ingest(
        spark, dataset, presets.INCIDENT_COLUMNS, ["Case Number"], "Primary Type", "Date", "Year", ["ID"], dt.date(2026, 1, 2), file_md5=True, summary=True
    )
    spec = presets.incident_cleaning(dt.date(2026, 1, 1))
    spec = type(spec)(**{**spec.__dict__, "rare_threshold": 5})
    return root, dataset, landed, spec, cleaning.run_cleaning(landed.table, spec)


def test_ingest_reports(flow, spark):
    root, dataset, landed, _, _ = flow
    reports = landed.reports
    assert reports["bad_lines"].first()[0] == 1
    assert {r["status"] for r in reports["schema"].collect()} == {"ok"}
    assert tuple(reports["shape"].first()) == (406, 22)
    assert reports["duplicate_rows"].first()[0] == 1
    assert reports["duplicate_keys"].first()[0] == 2
    assert reports["date_samples"].count() == 5
    bad = landed.quarantine.collect()
    assert [r["text"] for r in bad] == [incident_lines()[-1]] and bad[0]["reason"] == "too many fields"
    assert tuple(sources.read_latest(spark, dataset.raw_zone).columns) == tuple(landed.table.columns)
    assert sources.read_latest(spark, dataset.raw_zone).count() == 406
    manifest = read_json_document(spark, f"{dataset.catalog_zone}/ingestion_manifest").first()
    stored = {r["column_name"]: r for r in summaries.estimates(summaries.read_summaries(spark, f"{dataset.catalog_zone}/summaries")).collect()}
    assert stored["Case Number"]["row_count"] == 406 and abs(stored["ID"]["distinct_count"] - 405) < 10
    files = [p for p in (root / "raw").rglob("*.parquet")]
    assert (manifest["file_count"], manifest["size_bytes"]) == (len(files), sum(p.stat().st_size for p in files))
    assert (manifest["row_count"], manifest["column_count"], len(manifest["columns"])) == (406, 22, 22)
    assert manifest["checksum"] == integrity.table_fingerprint(landed.table, landed.table.columns).first()["fingerprint"]
    assert reports["file_checksums"].first()["md5"] == hashlib.md5((root / "incidents.csv").read_bytes()).hexdigest()


def test_cleaning_audit_balances(flow):
    _, _, landed, spec, result = flow
    steps = [tuple(r) for r in result.audit.orderBy("step_no").collect()]
    assert [s[1] for s in steps] == [
        "drop_exact_duplicates", "dedup_key", "drop_missing", "fill_missing", "fix_types",
        "bounding_box", "time_range", "merge_rare", "iqr_outliers",
    ]
    assert [s[4] for s in steps[:7]] == [1, 1, 1, 0, 1, 1, 0]
    for before, after in zip(steps, steps[1:]):
        assert before[3] == after[2]
    assert result.table.count() == steps[-1][3]
    assert result.table.columns == landed.table.columns


def test_rejected_rows_are_data(flow, spark, tmp_path):
    _, _, landed, spec, result = flow
    steps = {r["step"]: r["rows_dropped"] for r in result.audit.collect() if r["rows_dropped"]}
    rejects = result.rejects.collect()
    counted = {}
    for r in rejects:
        counted[r["step"]] = counted.get(r["step"], 0) + r["copies"]
    assert counted == steps
    raw = {tuple(r) for r in landed.table.collect()}
    assert all(tuple(r["row"]) in raw for r in rejects if r["step"] != "iqr_outliers")
    box = [r["row"] for r in rejects if r["step"] == "bounding_box"]
    assert [(r["ID"], r["Latitude"]) for r in box] == [("902", "10.0")]
    cleaning.save_cleaning(result, str(tmp_path / "cleaned"), str(tmp_path / "catalog"), str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).groupBy("step").agg(F.sum("copies")).count() == len(steps)


def test_the_audit_is_one_scan_of_the_staged_rows(flow, capsys):
    _, _, landed, spec, _ = flow
    staged = cleaning.judged(landed.table, spec)
    left = audit.rows_after_failures(staged, F.col("_failed"), ["drop_missing", "fix_types", "bounding_box"], first_no=3)
    left.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    rows = left.orderBy("step_no").collect()
    assert [r["step_no"] for r in rows] == [3, 4, 5] and rows[0]["rows_after"] >= rows[2]["rows_after"]
    none = audit.rows_after_failures(staged.limit(0), F.col("_failed"), ["a", "b"])
    assert [tuple(r) for r in none.collect()] == [(1, "a", 0), (2, "b", 0)]


def test_exact_copies_go_without_the_key_column(flow):
    _, _, landed, spec, _ = flow
    result = cleaning.run_cleaning(landed.table.drop("Case Number"), spec)
    dropped = [r["rows_dropped"] for r in result.audit.orderBy("step_no").collect()]
    assert dropped[:2] == [1, 0] and min(dropped) >= 0


def test_cleaned_values(flow):
    result = flow[4]
    assert {r[0] for r in result.table.select("Primary Type").distinct().collect()} == {
        "THEFT", "BATTERY", "NARCOTICS", "OTHER",
    }
    assert [r["value"] for r in result.rare.collect()] == ["RARE ONE"]
    kinds = dict(result.table.dtypes)
    assert (kinds["Date"], kinds["Ward"], kinds["Arrest"], kinds["Latitude"]) == (
        "timestamp_ntz", "bigint", "boolean", "double",
    )
    assert result.table.where(F.col("Location Description") == "UNKNOWN").count() > 100
    first = result.table.where(F.col("Case Number") == "HX5").collect()
    assert len(first) == 1 and first[0]["ID"] == 5


def test_skipping_the_exact_duplicate_step_changes_nothing(flow):
    _, _, landed, spec, _ = flow
    direct = cleaning.first_rows(landed.table, spec)
    after_distinct = cleaning.first_rows(clean.drop_exact_duplicates(landed.table), spec)
    assert direct.exceptAll(after_distinct).count() == 0
    assert after_distinct.exceptAll(direct).count() == 0


def test_features_catalogue_and_publication(flow, spark, tmp_path):
    root, dataset, landed, spec, result = flow
    cleaned_path = str(root / "processed" / "cleaned")
    cleaning.save_cleaning(result, cleaned_path, dataset.catalog_zone)
    cleaned = spark.read.parquet(cleaned_path)

    built = features.run_features(cleaned, presets.incident_features())
    scores = {r["feature"]: r["mi"] for r in built.scores.collect()}
    assert set(scores) == set(presets.CANDIDATES) and all(v >= 0 for v in scores.values())
    assert scores["hour"] > 0.5 and "hour" in built.selected
    assert list(built.selected) == [c for c in presets.CANDIDATES if scores[c] > 0.005]
    assert built.matrix.columns == [*built.selected, "crime_type_label"]
    assert built.matrix.count() == cleaned.count()
    assert sorted(r["value"] for r in built.label_map.collect()) == ["BATTERY", "NARCOTICS", "OTHER", "THEFT"]
    assert built.area_map.orderBy("code").first()["value"] == "0"

    features.save_features(built, str(root / "processed" / "features"), dataset.catalog_zone)

    totals = audit.audit_totals(result.audit)
    stages = [
        audit.stage(1, "raw", dataset.source, landed.path, totals.select(F.col("rows_raw").alias("row_count"))),
        audit.stage(2, "cleaned", landed.path, cleaned_path, totals.select(F.col("rows_cleaned").alias("row_count"))),
    ]
    documents = catalog.run_catalog(
        cleaned,
        landed.table,
        presets.INCIDENT_ANNOTATIONS,
        "Primary Type",
        "Date",
        stages,
        [("DQ-01", "data_quality", clean.any_missing(["Latitude", "Longitude"]))],
        {"processed": cleaned_path},
        dataset.catalog_zone,
    )
    assert documents["data_catalog"].count() == 22
    assert documents["lineage"].where("stage = 2").first()["rows_dropped"] == 406 - cleaned.count()
    assert documents["assumptions"].first()["rows_affected"] == 1
    assert documents["zone_registry"].count() > 0
    roles = {r["role"]: r["columns"] for r in documents["column_roles"].collect()}
    assert roles["excluded"] == "Arrest"

    rules = [
        validate.null_rule("Date"),
        validate.null_rule("Primary Type"),
        validate.range_rule("Latitude", presets.CITY_BOX.lat_min, presets.CITY_BOX.lat_max),
        validate.range_rule("Longitude", presets.CITY_BOX.lon_min, presets.CITY_BOX.lon_max),
    ]
    report = publishing.publish_and_validate(
        spark,
        cleaned,
        built.matrix,
        str(tmp_path / "published"),
        presets.INCIDENT_COLUMNS,
        built.selected,
        "crime_type_label",
        rules,
    )
    assert validate.verdict(report).first()["passed"]

    names = ["ingestion_manifest", "etl_report", "etl_totals", "data_catalog", "lineage", "assumptions",
             "zone_registry", "class_merges", "label_encoding", "area_encoding"]
    report = publishing.validate_published(
        spark,
        {"cleaned": str(tmp_path / "published" / "cleaned"), "features": str(tmp_path / "published" / "features")},
        presets.INCIDENT_COLUMNS,
        [*built.selected, "no_such_feature"],
        "crime_type_label",
        rules,
        expected_files=[("source", "incidents.csv"), ("source", "gone.csv")],
        zones={"source": str(root), "lost": str(root / "lost")},
        catalog_zone=dataset.catalog_zone,
        documents=names,
    )
    failed = sorted(r["rule"] for r in report.where(~F.col("passed")).collect())
    assert failed == ["files:source", "schema:features", "zone:lost"]


def test_exploration_tables(flow):
    _, _, _, spec, result = flow
    tables = exploration.run_exploration(result.table, spec)
    n = result.table.count()
    for name in ("hourly", "weekly", "monthly", "yearly", "class_balance", "spatial"):
        assert tables[name].agg(F.sum("row_count")).first()[0] == n, name
    assert tables["top_classes"].count() == 4
    assert tables["correlation"].count() == 25
    assert tables["coordinate_boxes"].count() == 2


def test_mixed_scoring_uses_both_estimators(flow, spark):
    result = flow[4]
    base = presets.incident_features()
    spec = FeatureSpec(**{**base.__dict__, "discrete": ("hour", "is_night"), "candidates": ("hour", "is_night", "Latitude")})
    built = features.run_features(result.table, spec)
    assert {r["feature"] for r in built.scores.collect()} == {"hour", "is_night", "Latitude"}


def test_ways_through_a_flow(spark):
    edges = spark.createDataFrame(
        [("a", "b", 10, 8), ("b", "c", 8, 5), ("a", "d", 10, 9), ("d", "c", 9, 9), ("c", "a", 14, 14)],
        "input string, output string, rows_in bigint, rows_out bigint",
    )
    ways = {(r["source"], r["target"], r["path"]): r["rows_dropped"] for r in audit.lineage_reach(edges).collect()}
    assert ways["a", "c", "a > b > c"] == 5 and ways["a", "c", "a > d > c"] == 1
    assert ways["c", "d", "c > a > d"] == 1 and ("a", "a", "a > b > c > a") not in ways
    assert audit.lineage_reach(edges.limit(0)).count() == 0
