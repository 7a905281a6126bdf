"""Quoted line ends, quarantined lines and arrival order, with files cut into many small blocks."""

import csv
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework import sources
from sievework.sources import delimited, records
from sievework.sources.records import Quoting

COLUMNS = ["id", "text", "tail"]


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def random_rows(seed, n):
    rng = random.Random(seed)
    pieces = ["a", "word", " ", ",", '"', '""', "\n", "\n\n", "é", "", "long " * 30, "\n" * 40, '",\n"', "\r\n", "x\ry"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 1, 2, 5])))
    return [(str(i), text(), text()) for i in range(n)]


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(COLUMNS)
        out.writerows(rows)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_records_of_many_blocks(spark, small_blocks, tmp_path, seed, end):
    files = [random_rows(seed * 10 + i, n) for i, n in enumerate((90, 1, 40))]
    for i, rows in enumerate(files):
        write(tmp_path / f"part-{i}.csv", rows, end)
    path = str(tmp_path)
    assert delimited._parsed(spark, path, COLUMNS, ",", True).rdd.getNumPartitions() > 1
    landed = sources.land_delimited(spark, path, COLUMNS, f"{tmp_path}/raw", "v1", "2026-01-01", missing_tokens=["\0none"])
    got = sources.landed_rows(spark, landed, COLUMNS, arrival=True)
    assert got.select("_position.file", "_position.block").distinct().count() > 20
    want = [tuple(x or None for x in r) for rows in files for r in rows]
    assert [tuple(r)[:3] for r in got.orderBy("_position").collect()] == want
    assert sources.quarantined_lines(spark, landed).count() == 0


def test_single_line_files_arrive_in_order_too(spark, small_blocks, tmp_path):
    rows = [(str(i), f"text {i}", "x") for i in range(200)]
    write(tmp_path / "a.csv", rows)
    assert not records.has_quoted_line_ends(spark, str(tmp_path / "a.csv"))
    landed = sources.land_delimited(spark, str(tmp_path / "a.csv"), COLUMNS, f"{tmp_path}/raw", "v1", "2026-01-01")
    got = sources.landed_rows(spark, landed, COLUMNS, arrival=True)
    assert [tuple(r)[:3] for r in got.orderBy("_position").collect()] == rows


def test_first_row_of_the_file(spark, small_blocks, tmp_path):
    """A key that repeats all over the file keeps the row that stands first, whatever its values."""
    rng = random.Random(4)
    rows = [(str(rng.randrange(30)), f"line\n{i}", str(rng.randrange(9))) for i in range(150)]
    write(tmp_path / "a.csv", rows)
    landed = sources.land_delimited(spark, str(tmp_path / "a.csv"), COLUMNS, f"{tmp_path}/raw", "v1", "2026-01-01")
    got = sources.landed_rows(spark, landed, COLUMNS, arrival=True).repartition(5)
    first = got.withColumn("n", F.row_number().over(W.partitionBy("id").orderBy("_position"))).filter("n = 1")
    want = {}
    for r in rows:
        want.setdefault(r[0], r)
    assert sorted(tuple(r)[:3] for r in first.collect()) == sorted(want.values())


@pytest.mark.parametrize("newline", [False, True])
def test_accepted_and_quarantined_rows_are_one_parse(spark, small_blocks, tmp_path, newline, capsys):
    text = "one\nline" if newline else "one line"
    lines = [f'{i},"{text}",x' + (",more" if i % 7 == 0 else "") for i in range(60)]
    (tmp_path / "a.csv").write_text("id,text,tail\n" + "\n".join(lines) + "\n")
    landed = sources.land_delimited(spark, str(tmp_path / "a.csv"), COLUMNS, f"{tmp_path}/raw", "v1", "2026-01-01")
    kept = sources.landed_rows(spark, landed, COLUMNS)
    assert sorted(int(r.id) for r in kept.collect()) == [i for i in range(60) if i % 7]
    assert {r.text for r in kept.collect()} == {text}
    bad = sources.quarantined_lines(spark, landed).orderBy("file", "block", "line").collect()
    assert [r.text for r in bad] == [line for i, line in enumerate(lines) if i % 7 == 0]
    assert {r.reason for r in bad} == {"too many fields"}
    assert sources.bad_line_count(spark, str(tmp_path / "a.csv"), COLUMNS).first()[0] == len(bad)
    assert (tmp_path / "raw" / "version=v1" / "ingest_date=2026-01-01" / "_SUCCESS").exists()
    staged = sources.staged_rows(spark, str(tmp_path / "a.csv"), COLUMNS)
    staged.explain()
    plan = capsys.readouterr().out
    # One parse: whole records and those that cross blocks are two reads of one file, without quoted line ends it is one.
    assert plan.count("FileScan text") == 2 * newline and plan.count("FileScan csv") == 1 - newline


def test_what_is_refused(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('id,text,tail\n1,"x\n2,y,z\n')
    with pytest.raises(ValueError, match="never closed"):
        sources.read_delimited(spark, str(path), COLUMNS)
    path = tmp_path / "lines.csv"
    path.write_text('id,text,tail\n1,"x\ny",2\n')
    with pytest.raises(ValueError, match="multi_line"):
        sources.read_delimited(spark, str(path), COLUMNS, multi_line=False)
    assert [tuple(r) for r in sources.read_delimited(spark, str(path), COLUMNS).collect()] == [("1", "x\ny", "2")]
    with pytest.raises(Exception, match="unlike header"):
        sources.read_delimited(spark, str(path), ["id", "text", "other"]).collect()
    path = tmp_path / "empty.csv"
    path.write_text("id,text,tail\n")
    assert sources.read_delimited(spark, str(path), COLUMNS, multi_line=True).count() == 0


def test_a_quote_inside_a_plain_field_opens_nothing(spark, tmp_path):
    path = tmp_path / "inch.csv"
    path.write_text('id;text;tail\n1;5" pipe;x\n2;"a\n;b";y\n3;6" pipe;"z"\n')
    got = sources.read_delimited(spark, str(path), COLUMNS, sep=";").collect()
    assert sorted(tuple(r) for r in got) == [("1", '5" pipe', "x"), ("2", "a\n;b", "y"), ("3", '6" pipe', "z")]


def test_states_of_a_line():
    after = Quoting(",").after
    assert after("a,b") == (False, True) and after('a,"b') == (True, False) and after('b",c,"d') == (True, True)
    assert after('5" pipe') == (False, False) and after('""') == (False, True) and after('"') == (True, False)
    assert after('"' * 20_002 + ",x" * 20_000) == (False, True)


@pytest.mark.parametrize("blocks", [1, 5, 40])
def test_states_compose_over_blocks(spark, blocks):
    rng = random.Random(blocks)
    kinds = [(False, False), (True, True), (False, True), (True, False)]
    rows, inside, begun, want = [], False, None, []
    for b in range(blocks):
        ends, last = rng.choice(kinds), [rng.choice([None, b + 1]), rng.choice([None, b + 2])]
        rows.append(("f", b, *ends, *last))
        want.append((b, inside, *(begun or (None, None))))
        begun = (b, last[inside]) if last[inside] is not None else begun
        inside = ends[inside]
    states = spark.createDataFrame(rows, "file string, block long, end0 boolean, end1 boolean, last0 long, last1 long").repartition(3)
    got = records.block_starts(states).orderBy("block").collect()
    assert [(r.block, r.inside, r.of_block, r.of_line) for r in got] == want
    assert got[-1].ends_inside == inside
