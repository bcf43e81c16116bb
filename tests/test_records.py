"""CSV records over many splits, against a reader that takes a file whole."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stagetally.plans import imports
from stagetally.sources import exports
from stagetally.sources.records import csv_records, ends_inside


def slow_end(line, inside):
    """The state after a line, character by character."""
    at, fresh, i = ("in" if inside else "out"), not inside, 0
    while i < len(line):
        c = line[i]
        if at == "in" and c == '"':
            if line[i + 1 : i + 2] == '"':
                i += 1
            else:
                at = "out"
            fresh = False
        elif at == "out":
            if c == '"' and fresh:
                at = "in"
            fresh = c == ","
        i += 1
    return at == "in"


def test_ends_of_lines(spark):
    rng = random.Random(1)
    lines = {"".join(rng.choice('",a ') for _ in range(rng.randrange(9))) for _ in range(600)}
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    found = rows.select("line", ends_inside(rows.line, False), ends_inside(rows.line, True)).collect()
    assert {tuple(r) for r in found} == {(x, slow_end(x, False), slow_end(x, True)) for x in lines}


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    spark.conf.set("spark.sql.files.minPartitionNum", 1)


@pytest.fixture
def splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: small_splits(spark, size)
    for n, v in before.items():
        spark.conf.set(n, v)
    spark.conf.unset("spark.sql.files.minPartitionNum")


def records(spark, folder):
    found = csv_records(spark, [str(folder)]).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["path"], r["number"])):
        out.setdefault(r["path"].rsplit("/", 1)[1], []).append((r["number"], r["record"]))
    return out


def made(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    field = lambda: "".join(rng.choice(['"', ",", "\n", "a", "bc", " ", "\n\n", "é"]) for _ in range(rng.randrange(6)))
    table = [[str(i), *(field() for _ in range(3))] for i in range(rows)]
    writer.writerows(table)
    return table, out.getvalue()


@pytest.mark.parametrize("size", ["40b", "500b", "1m"])
def test_records_over_splits(spark, tmp_path, splits, size):
    rng = random.Random(7)
    tables = {}
    for i in range(3):
        tables[f"f{i}.csv"], text = made(rng, 60)
        (tmp_path / f"f{i}.csv").write_text(text, newline="")
    splits(size)
    found = records(spark, tmp_path)
    for name, table in tables.items():
        assert [n for n, _ in found[name]] == list(range(1, 61))
        assert [next(csv.reader(io.StringIO(r), strict=True)) for _, r in found[name]] == table


def test_odd_files(spark, tmp_path, splits):
    texts = {"a.csv": "", "b.csv": "\n\nx,y\n\n1,2\r\n", "c.csv": 'x\n"open\n\nto the end', "d.csv": 'x\n5" pipe,y\n"a" b,"c"\n', "e.csv": '"x\r\ny",z'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    for size in ("3b", "1m"):
        splits(size)
        found = {n: [r for _, r in own] for n, own in records(spark, tmp_path).items()}
        assert found == {"b.csv": ["x,y", "1,2"], "c.csv": ["x", '"open\n\nto the end'], "d.csv": ["x", '5" pipe,y', '"a" b,"c"'], "e.csv": ['"x\ny",z']}


def whole_files(spark, folder, columns):
    """The rows as Spark's own reader gives them when each file is one task."""
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, "malformed"])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.option("columnNameOfCorruptRecord", "malformed").option("columnPruning", False).csv(str(folder))


def test_exports_are_read_as_by_one_task_per_file(spark, tmp_path, splits):
    rng = random.Random(5)
    folder = tmp_path / "deals 2025-01-01.csv"
    folder.mkdir()
    columns = ["Record ID", "Deal Name", "Amount", "Deal Stage"]
    for i in range(2):
        table, text = made(rng, 80)
        lines = text + "7,too,few\n8,far,too,many,fields\n" + '9,"quoted ""twice""",,""\n'
        (folder / f"part-{i}.csv").write_text(",".join(columns) + "\n" + lines, newline="")
    want = sorted(map(str, whole_files(spark, folder, columns).drop("malformed").collect()))
    splits("300b")
    (group,) = exports.read_export_groups(spark, str(tmp_path))
    assert group.frame.rdd.getNumPartitions() > 0 and group.kind == "deal"
    plan = group.frame._jdf.queryExecution().executedPlan().toString()
    assert "multiLine" not in plan
    assert sorted(map(str, group.frame.select(*columns).collect())) == want
    bad = imports.malformed_records([group]).collect()
    assert sorted(r["malformed"] for r in bad) == ["7,too,few"] * 2 + ["8,far,too,many,fields"] * 2
    assert {r["export_date"] for r in group.frame.select("export_date").collect()} == {"2025-01-01"}


@given(st.lists(st.text(alphabet='",a', max_size=8), max_size=6))
@settings(max_examples=200, deadline=None)
def test_answers_put_together_are_those_of_the_whole(lines):
    state = False
    for line in lines:
        state = slow_end(line, state)
    answers, back = [(slow_end(x, False), slow_end(x, True)) for x in lines], False
    for out, inn in answers:
        back = inn if back else out
    assert back == state
