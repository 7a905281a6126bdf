import hashlib

import pytest
from pyspark.sql import functions as F

from sievework import sources

COLUMNS = ["a", "b", "c"]
TEXT = 'a,b,c\n1,2,3\n1,2\n1,2,3,\n1,2,3,4\n1,2,3,,5\n"x ""q"", y",2,3\n"x,y",2\nNA,null,3\n'


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(TEXT)
    return str(path)


def test_long_lines_are_left_out_and_short_ones_padded(spark, rows, csv):
    df = sources.read_delimited(spark, csv, COLUMNS)
    expected = sorted(
        [("1", "2", "3"), ("1", "2", None), ('x "q", y', "2", "3"), ("x,y", "2", None), (None, None, "3")], key=repr
    )
    assert rows(df) == expected
    assert df.count() == 5
    assert rows(df.select("b")) == sorted([(r[1],) for r in expected], key=repr)
    assert rows(sources.bad_line_count(spark, csv, COLUMNS)) == [(3,)]
    assert sources.read_delimited(spark, csv, COLUMNS, on_bad_lines="keep").count() == 8
    with pytest.raises(Exception, match="too many fields"):
        sources.read_delimited(spark, csv, COLUMNS, on_bad_lines="error").collect()
    assert sources.header_columns(spark, csv) == COLUMNS


def test_versions_land_once_and_the_newest_is_read(spark, tmp_path):
    root = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        sources.latest_version(spark, root)
    sources.land_raw(spark.range(3), root, "v1.9", "2026-03-01")
    sources.land_raw(spark.range(4), root, "v1.10", "2026-02-01")
    path = sources.land_raw(spark.range(5), root, "v1.10", "2026-02-02")
    assert sources.land_raw(spark.range(99), root, "v1.10", "2026-02-02") == path
    assert sources.read_latest(spark, root).count() == 5
    assert sources.read_latest(spark, root, "v1.9").count() == 3


def test_what_a_failed_landing_left_behind_is_replaced(spark, tmp_path):
    folder = tmp_path / "raw" / "version=v1" / "ingest_date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"half a file")
    root = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        sources.latest_version(spark, root, "v1")
    sources.land_raw(spark.range(2), root, "v1", "2026-01-01")
    assert sources.read_latest(spark, root).count() == 2


def test_inventory_and_checksums(spark, tmp_path, rows):
    (tmp_path / "one.json").write_text("{}")
    (tmp_path / "two.bin").write_bytes(b"x" * 2_000_000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "three").write_text("no")
    (tmp_path / "day=1").mkdir()
    inventory = sources.file_inventory(spark, {"z": str(tmp_path), "gone": str(tmp_path / "gone")})
    assert rows(inventory.select("zone", "filename", "size_mb")) == [("z", "one.json", 0.0), ("z", "two.bin", 1.91)]
    everything = sources.file_inventory(spark, {"z": str(tmp_path)}, recursive=True)
    assert {r["filename"] for r in everything.collect()} == {"one.json", "two.bin", "three"}
    sums = {r["filename"]: r["md5"] for r in sources.file_checksums(spark, str(tmp_path)).collect()}
    assert sums["two.bin"] == hashlib.md5(b"x" * 2_000_000).hexdigest()


def test_csv_export_keeps_blanks_and_quotes(spark, tmp_path, rows):
    df = spark.createDataFrame([(" a ", 'q "x", y', None)], "a string, b string, c string")
    sources.write_processed(df, str(tmp_path / "out"), "csv")
    assert rows(sources.read_delimited(spark, str(tmp_path / "out"), COLUMNS)) == [(" a ", 'q "x", y', None)]
    with pytest.raises(ValueError):
        sources.write_processed(df, str(tmp_path / "out"), "xml")


def test_processed_and_published_tables_keep_their_types(spark, tmp_path):
    df = spark.range(3).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("Date"), (F.col("id") > 1).alias("f"))
    sources.write_processed(df, str(tmp_path / "p"))
    assert sources.read_processed(spark, str(tmp_path / "p")).dtypes == df.dtypes
    sources.write_features(df, str(tmp_path / "x"), ["id"])
    assert sources.read_processed(spark, str(tmp_path / "x")).columns == ["id"]
    places = sources.publish({"a": df, "b": df.limit(1)}, (tmp_path / "pub").as_uri())
    sources.publish({"a": df, "b": df.limit(2)}, (tmp_path / "pub").as_uri())
    assert sources.read_processed(spark, places["b"]).count() == 2


def test_documents(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text('{"stages": [1, 2], "categories": {"x": [{"id": 1}], "y": [{"id": 2}, {"id": 3}]}}')
    schema = "stages array<int>, categories map<string, array<struct<id:int>>>, columns array<string>"
    counts = sources.document_counts(sources.read_json_document(spark, str(path), schema, multi_line=True)).first().asDict()
    assert counts == {"stages_count": 2, "categories_count": 2, "categories_total": 3, "columns_count": 0}
    sources.write_json_document(spark.range(2), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 2
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.json").write_text('{"a": 1}\n{"a": \n')
    checked = {r["document"]: (r["entries"], r["broken"]) for r in sources.document_check(spark, str(tmp_path), ["r", "broken", "gone"]).collect()}
    assert checked == {"r": (2, 0), "broken": (2, 1), "gone": (0, 0)}
    (tmp_path / "indented.json").write_text('{\n  "a": 1,\n  "b": [1,\n 2]\n}\n')
    assert tuple(sources.document_check(spark, str(tmp_path), ["indented.json"]).first())[1:] == (1, 0)


@pytest.mark.parametrize("n", [3, 1500, 5000])
def test_head_sample(spark, n):
    df = spark.range(4000).select(F.col("id"), F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("name"))
    shuffled = df.repartition(7)
    for key in ("id", "name"):
        got = sorted(r["id"] for r in sources.head_sample(shuffled, n, [key]).collect())
        assert got == list(range(min(n, 4000)))


def test_a_large_head_stays_spread(spark, monkeypatch):
    from sievework.sources import tables

    monkeypatch.setattr(tables, "MAX_HEAD", 100)
    df = spark.range(4000).select(F.when(F.col("id") < 3990, F.col("id")).alias("a"), F.col("id").alias("b")).repartition(7)
    for n in (101, 3995, 10**7):
        got = sources.head_sample(df, n, ["a", "b"])
        assert got.columns == ["a", "b"] and sorted(r.b for r in got.collect()) == list(range(min(n, 4000)))


def test_quoted_newlines_and_headers(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"x\ny",3\n4,5,6\n')
    read = sources.read_delimited(spark, str(tmp_path / "a.csv"), COLUMNS, multi_line=True)
    assert rows(read) == [("1", "x\ny", "3"), ("4", "5", "6")]
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "one.csv").write_text("a,b,c\n1,2,3\n")
    (tmp_path / "mixed" / "two.csv").write_text("b,a,c\n2,1,3\n")
    with pytest.raises(Exception, match="header"):
        sources.read_delimited(spark, str(tmp_path / "mixed"), COLUMNS).collect()


def test_of_two_writers_one_publishes(spark, tmp_path):
    place = str(tmp_path / "table")
    assert sources.publish_version(spark.range(3), place) == 1
    assert sources.publish_version(spark.range(5), place, after=1) == 2
    held = sources.read_processed(spark, place)
    with pytest.raises(sources.PublishConflict):
        sources.publish_version(spark.range(9), place, after=1)
    assert sources.read_processed(spark, place).count() == 5 and sources.published_version(spark, place) == 2
    assert sources.publish_version(spark.range(7), place) == 3
    assert held.count() == 5 and sources.read_processed(spark, place).count() == 7
    assert len(list((tmp_path / "table").glob("data-*"))) == 3


def test_a_failed_publication_changes_nothing(spark, tmp_path):
    place = str(tmp_path / "table")
    sources.publish_version(spark.range(3), place)
    with pytest.raises(Exception, match="broken"):
        sources.publish_version(spark.range(10).select(F.when(F.col("id") > 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("x")), place)
    (tmp_path / "table" / "_versions" / "0000000002").write_text("")
    assert sources.read_processed(spark, place).count() == 3


def test_landings_are_moved_whole(spark, tmp_path):
    from sievework.sources import paths

    root = str(tmp_path / "raw")
    with pytest.raises(Exception, match="broken"):
        sources.land_raw(spark.range(10).select(F.when(F.col("id") > 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("x")), root, "v1", "2026-01-01")
    assert not (tmp_path / "raw" / "version=v1").exists()
    path = sources.land_raw(spark.range(4), root, "v1", "2026-01-01")
    # Another writer that ends later: its rows are put away, those that landed stay.
    spark.range(9).write.parquet(f"{root}/_landing-late")
    assert not paths.move_folder(spark, f"{root}/_landing-late", path)
    assert not (tmp_path / "raw" / "_landing-late").exists()
    assert sources.land_raw(spark.range(9), root, "v1", "2026-01-01") == path and sources.read_latest(spark, root).count() == 4
