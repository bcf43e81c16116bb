"""Upserts by file, against the plain merge of whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from stagetally.session import literal_table
from stagetally.sources import merging, warehouse as store
from stagetally.sources.warehouse import Warehouse
from tests.fixtures import S1, S2, company, table


def owner_rows(spark, n):
    rows = [{"owner_id": str(i), "email": f"e{i}", "first_name": "F", "record_timestamp": S1} for i in range(n)]
    return table(spark, "owners", rows + [{"owner_id": None, "email": "none"}])


def files(warehouse, name):
    rows = warehouse.read_with_files(name).groupBy("_file").count().collect()
    return {r["_file"]: r["count"] for r in rows}


def shown(df):
    return sorted(map(str, df.collect()))


def test_only_files_with_matched_rows_are_rewritten(spark, warehouse):
    warehouse.append_table(owner_rows(spark, 400).repartitionByRange(40, "owner_id"), "owners")
    before = files(warehouse, "owners")
    assert len(before) >= 35
    keys = random.Random(1).sample(range(400), 7) + [1000, 1001, 1002]
    source = literal_table(spark, [(k, f"new{k}") for k in keys] + [(None, "added")], "owner_id bigint, email string")
    want = shown(store.merge_rows(warehouse.read("owners"), source.withColumn("owner_id", F.col("owner_id").cast("string")), "owner_id"))
    warehouse.upsert_table(source, "owners", "owner_id")
    after = files(warehouse, "owners")
    assert shown(warehouse.read("owners")) == want and len(want) == 400 + 1 + 3 + 1
    assert 1 <= len(set(before) - set(after)) <= 7
    assert all(after[f] == n for f, n in before.items() if f in after)


def test_partitioned_table_with_other_names(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "my tables"), prefix="x_", column_names={"companies": {"owner_id": "their owner"}})
    rows = [company(str(i), "lead", s, owner_id="o") for i in range(20) for s in (S1,)] + [company(str(20 + i), "lead", S2) for i in range(20)]
    warehouse.append_table(table(spark, "companies", rows), "companies")
    before = files(warehouse, "companies")
    source = table(spark, "companies", [company("3", "won", S2, owner_id="p"), company("99", "new", S1)])
    warehouse.upsert_table(source, "companies", "company_id")
    found = {r["company_id"]: (r["lifecycle_stage"], r["owner_id"], r["snapshot_id"].day) for r in warehouse.read("companies").collect()}
    assert found["3"] == ("won", "p", 8) and found["99"] == ("new", "o1", 1) and found["25"] == ("lead", "o1", 8) and len(found) == 41
    assert len(set(before) - set(files(warehouse, "companies"))) == 1
    assert warehouse.read_table_for_snapshot("companies", S2).count() == 21


def test_no_match_and_no_table(spark, warehouse):
    source = literal_table(spark, [("1", "a")], "owner_id string, email string")
    warehouse.upsert_table(source, "owners", "owner_id")
    before = files(warehouse, "owners")
    warehouse.upsert_table(literal_table(spark, [("2", "b")], "owner_id string, email string"), "owners", "owner_id")
    warehouse.upsert_table(source.limit(0), "owners", "owner_id")
    assert set(before) <= set(files(warehouse, "owners"))
    assert sorted(r["email"] for r in warehouse.read("owners").collect()) == ["a", "b"]


@pytest.mark.parametrize("step", ["noted", "moved"])
def test_a_swap_that_was_cut_off_is_ended_by_the_next_writer(spark, warehouse, monkeypatch, step):
    warehouse.append_table(owner_rows(spark, 30).repartition(3), "owners")
    source = literal_table(spark, [("5", "new")], "owner_id string, email string")
    with monkeypatch.context() as patch:
        if step == "noted":
            patch.setattr(merging, "finish_swaps", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        else:
            whole = merging._move_in

            def dies(*args):
                whole(*args)
                raise OSError("lost")

            patch.setattr(merging, "_move_in", dies)
        with pytest.raises(OSError, match="lost"):
            warehouse.upsert_table(source, "owners", "owner_id")
    assert merging.finish_swaps(warehouse, "owners") == 1 and merging.finish_swaps(warehouse, "owners") == 0
    emails = [r["email"] for r in warehouse.read("owners").collect()]
    assert len(emails) == 31 and emails.count("new") == 1 and "e5" not in emails
    fs, root = warehouse._fs(warehouse.root)
    assert [s.getPath().getName() for s in fs.listStatus(root)] == ["owners"]


def test_a_source_that_raises_changes_nothing(spark, warehouse):
    warehouse.append_table(owner_rows(spark, 10), "owners")
    before = shown(warehouse.read("owners"))
    bad = literal_table(spark, [("1", "x")], "owner_id string, email string").withColumn("email", F.raise_error(F.lit("midway")).cast("string"))
    with pytest.raises(Exception, match="midway"):
        warehouse.upsert_table(bad, "owners", "owner_id")
    assert shown(warehouse.read("owners")) == before
