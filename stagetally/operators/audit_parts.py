"""Audit results of one table and snapshot, which add up to the audit of all.

A part is a row (table, snapshot_id, kind, field, value, n).  Fact tables are
audited per snapshot, so parts of snapshots that did not change can be kept;
merging them gives the issues of the full audit.

Reference values and keys are kept whole, since an orphan is known only when all
are there.  Rules that test a value by itself leave their total (value NULL) and
their first values (n 0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.operators import integrity
from stagetally.schemas import FACT_TABLES, TABLES, UNIQUE_KEYS
from stagetally.session import literal_table

#: The number of the layout of parts, and how many values of a rule are shown.
_LAYOUT, _SAMPLES = 2, 5
PARTS = "table string, snapshot_id timestamp, kind string, field string, value string, n bigint"
_IDS = {"companies": "company_id", "deals": "deal_id"}
#: The fields that references of any table point to.
_KEYS = sorted({target for fields, _ in integrity.VALUE_RULES.values() for by in fields.values() for target in by.values() if target})


def rules_version() -> str:
    """Changes with the rules, so that parts made under other rules are not used."""
    rules = (_LAYOUT, _SAMPLES, integrity.COUNTER_RULES, integrity.VALUE_RULES, UNIQUE_KEYS, _KEYS)
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _value_rules(table: str, references: bool) -> dict[str, str]:
    """Kind and field of the value rules of a table, those for references or the others, and SQL for offending values."""
    return {
        f"value:{rule}|{f}": f"CASE WHEN {f} <> '' AND {test.format(c=f)} THEN {f} END"
        for rule, (fields, test) in integrity.VALUE_RULES.items()
        for f, target in fields.get(table, {}).items()
        if bool(target) == references
    }


def _values(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Values of named expressions: (snapshot_id, _name, value), none of them NULL."""
    wide = df.selectExpr("snapshot_id", *[f"{e} AS `{n}`" for n, e in columns.items()])
    return wide.unpivot(["snapshot_id"], [f"`{n}`" for n in columns], "_name", "value").filter("value IS NOT NULL")


def parts_of(table: str, df: DataFrame) -> DataFrame:
    """The parts of some snapshots of a table (of all its rows, under a NULL id, if it has none)."""
    if table == "snapshot_registry":
        df = df.withColumnRenamed("snapshot_id", "_id")
    elif "snapshot_id" not in df.columns:
        df = df.withColumn("snapshot_id", F.lit(None).cast("timestamp"))
    of_table = F.lit(table).alias("table")
    sums = {"rows||": "count(1)"}
    for rule, (fields, text_test, other_test) in integrity.COUNTER_RULES.items():
        for f in fields.get(table, []):
            is_text = isinstance(TABLES[table][f].dataType, T.StringType)
            column = "_id" if f == "snapshot_id" and table == "snapshot_registry" else f
            test = (text_test if is_text else other_test).format(c=column)
            sums[f"counter|{rule}|{f}"] = f"sum(CASE WHEN {test} THEN 1 ELSE 0 END)"
    if table == "snapshot_registry":
        return _registry_parts(df, sums).select(of_table, F.lit(None).cast("timestamp").alias("snapshot_id"), "kind", "field", "value", "n")
    out = []
    alone, references = _value_rules(table, False), _value_rules(table, True)
    for name, e in alone.items():
        kind, f = name.split("|")
        sums[f"{kind}||{f}"] = f"count({e})"
    counted = df.groupBy("snapshot_id").agg(*[F.expr(f"CAST({e} AS bigint)").alias(name) for name, e in sums.items()])
    named = F.split("_name", r"\|")
    out.append(
        counted.unpivot(["snapshot_id"], [f"`{s}`" for s in sums], "_name", "n").select(
            of_table, "snapshot_id", named[0].alias("kind"), named[2].alias("field"), F.nullif(named[1], F.lit("")).alias("value"), "n"
        )
    )
    split = [of_table, "snapshot_id", named[0].alias("kind"), named[1].alias("field"), "value", "n"]
    if alone:
        ranked = Window.partitionBy("snapshot_id", "_name").orderBy("value")
        first = _values(df, alone).distinct().withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= _SAMPLES)
        out.append(first.withColumn("n", F.lit(0).cast("bigint")).select(*split))
    if references:
        out.append(_values(df, references).groupBy("snapshot_id", "_name", "value").agg(F.count(F.lit(1)).alias("n")).select(*split))

    def grouped(keys):
        return df.groupBy(*dict.fromkeys([*keys, "snapshot_id"])).agg(F.count(F.lit(1)).alias("n"))

    for f in [k.split(".")[1] for k in _KEYS if k.split(".")[0] == table]:
        # The test on the count keeps the shuffle equal to that of the duplicates, which then share it.
        present = grouped([f]).withColumn("value", F.when(F.col("n") > 0, F.col(f))).filter("value IS NOT NULL")
        out.append(present.select(of_table, "snapshot_id", F.lit("key").alias("kind"), F.lit(f).alias("field"), "value", "n"))
    if table in UNIQUE_KEYS:
        groups = grouped(UNIQUE_KEYS[table])
        counts = _duplicates()
        if table in _IDS:
            counts["distinct_ids"] = F.count_if(F.col(_IDS[table]).isNotNull())
        sized = groups.groupBy("snapshot_id").agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
        out.append(
            sized.unpivot(["snapshot_id"], list(counts), "kind", "n").select(
                of_table, "snapshot_id", "kind", F.lit("").alias("field"), F.lit("").alias("value"), "n"
            )
        )
    return reduce(DataFrame.unionByName, out)


def _duplicates() -> dict[str, Column]:
    """Aggregates over the rows per unique key (n)."""
    return {
        "duplicate_groups": F.count_if(F.col("n") > 1),
        "duplicate_records": F.sum(F.greatest(F.col("n") - 1, F.lit(0))),
    }


def _registry_parts(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Parts of the registry, one of each kind per snapshot id (``_id``): rows per key carry all counts, so its log is folded once."""
    keys = ["_id" if k == "snapshot_id" else k for k in UNIQUE_KEYS["snapshot_registry"]]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.expr(e).alias(name) for name, e in sums.items()])
    counts = {name: F.sum(f"`{name}`") for name in sums} | {f"{kind}||": c for kind, c in _duplicates().items()}
    per_id = groups.groupBy("_id").agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
    per_id = per_id.withColumn("id||", F.lit(1).cast("bigint"))
    named = F.split("_name", r"\|")
    kind = named[0].alias("kind")
    value = F.when(kind == "id", F.col("_id").cast("string")).otherwise(named[1]).alias("value")
    found = per_id.unpivot(["_id"], [f"`{c}`" for c in per_id.columns if c != "_id"], "_name", "n")
    return found.select(kind, named[2].alias("field"), value, "n").filter("kind <> 'id' OR value IS NOT NULL")


def merged_issues(parts: DataFrame, tables: list[str]) -> DataFrame:
    """The issues of all checks from the parts of the given tables; ``parts`` should be stored."""
    spark = parts.sparkSession
    present: Mapping[str, None] = dict.fromkeys(tables)
    counters = (
        parts.filter("kind = 'counter'")
        .groupBy(F.col("value").alias("rule"), "table", "field")
        .agg(F.sum("n").alias("count"))
    )
    usable = {r: integrity._present(rule, present) for r, rule in integrity.VALUE_RULES.items()}
    numbered = integrity._rule_table(present, usable)
    names = [(n, f"value:{rule}", t, f) for n, rule, t, f, target in numbered if not target]
    names = literal_table(spark, names, "number string, kind string, table string, field string")
    values = parts.join(names, ["kind", "table", "field"]).select("number", "value", "n")
    references = [r for r in numbered if r[4]]
    if references:
        values = values.unionByName(_orphans(parts, references))
    # Few rows reach this: some values of each snapshot, and of each bucket of references.
    found = values.groupBy("number").agg(
        F.sum("n").alias("count"), F.slice(F.sort_array(F.collect_set("value")), 1, _SAMPLES).alias("sample_values")
    )
    duplicates = (
        parts.filter("kind IN ('duplicate_groups', 'duplicate_records')")
        .groupBy("table")
        .pivot("kind", ["duplicate_groups", "duplicate_records"])
        .agg(F.sum("n"))
    )
    field = F.lit(None).cast("string")
    for table, unique in UNIQUE_KEYS.items():
        field = F.when(F.col("table") == table, f"({', '.join(unique)})").otherwise(field)
    duplicates = duplicates.select("table", field.alias("field"), F.col("duplicate_records").alias("count"), "duplicate_groups")
    issues = [
        integrity.counter_issue_rows(counters),
        integrity.numbered_issue_rows(found.filter("count > 0"), numbered),
        integrity.duplicate_issue_rows(duplicates),
    ]
    facts = [t for t in FACT_TABLES if t in present]
    if "snapshot_registry" in present:
        known = parts.filter(F.col("kind") == "rows").filter(F.col("table").isin(facts)).filter("n > 0")
        ids = known.select(F.col("snapshot_id").cast("string").alias("value"), F.col("table").alias("of"))
        ids = ids.unionByName(parts.filter("kind = 'id'").select("value", F.col("table").alias("of"))).distinct()
        issues.append(integrity.consistency_issue_rows(ids, facts))
    if len(facts) == len(FACT_TABLES):
        per_snapshot = parts.filter("kind = 'distinct_ids'").groupBy("snapshot_id").agg(
            *[F.coalesce(F.sum(F.when(F.col("table") == t, F.col("n"))), F.lit(0).cast("bigint")).alias(t) for t in facts]
        )
        issues.append(integrity.distribution_anomalies(per_snapshot))
    return reduce(DataFrame.unionByName, issues)


def _orphans(parts: DataFrame, references: list[tuple]) -> DataFrame:
    """Totals and first values of references without a key: (number, value, n), some rows per bucket of values.

    References and the keys they point to meet in one aggregate over buckets of
    the values, and each bucket is reduced where it lies, so all values are
    shuffled once.  They are nearly all different: they are dealt into the
    session's partitions before they are counted, for a partial count would only
    fill memory.
    """
    spark = parts.sparkSession
    targets = sorted({r[4] for r in references})
    by_target = {t: [r for r in references if r[4] == t] for t in targets}
    names = [("key", *t.split("."), i, 0) for i, t in enumerate(targets)]
    names += [(f"value:{r[1]}", r[2], r[3], i, p) for i, t in enumerate(targets) for p, r in enumerate(by_target[t], 1)]
    names = literal_table(spark, names, "kind string, table string, field string, target int, place int")
    numbers = literal_table(
        spark, [(r[0], i, p) for i, t in enumerate(targets) for p, r in enumerate(by_target[t])], "number string, target int, place int"
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.join(names, ["kind", "table", "field"]).select("target", "value", "place", "n")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("target", "value"), F.lit(16 * partitions)).cast("int"))
    counts = [F.sum(F.when(F.col("place") == p, F.col("n"))).alias(f"n{p}") for p in range(1, 1 + max(map(len, by_target.values())))]
    met = (
        rows.repartition(partitions, "bucket")
        .groupBy("bucket", "target", "value")
        .agg(F.bool_or(F.col("place") == 0).alias("known"), *counts)
        .filter("NOT known")
    )
    each = met.select("bucket", "target", "value", F.posexplode(F.array(*[f"n{p}" for p in range(1, 1 + len(counts))])).alias("place", "n"))
    own = Window.partitionBy("bucket", "target", "place")
    first = each.filter("n IS NOT NULL").withColumns(
        {"_n": F.row_number().over(own.orderBy("value")), "_total": F.sum("n").over(own)}
    )
    first = first.filter(F.col("_n") <= _SAMPLES).withColumn("n", F.when(F.col("_n") == 1, F.col("_total")).otherwise(0))
    return first.join(numbers, ["target", "place"]).select("number", "value", "n")


def merged_counts(parts: DataFrame, tables: list[str]) -> DataFrame:
    """Rows per table."""
    counted = parts.filter("kind = 'rows'").groupBy("table").agg(F.sum("n").alias("n"))
    names = literal_table(parts.sparkSession, [(t,) for t in tables], "table string")
    return names.join(counted, "table", "left").select("table", F.coalesce("n", F.lit(0).cast("bigint")).alias("rows"))
