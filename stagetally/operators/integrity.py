"""Integrity checks.  Each returns issue rows of one schema; no problem, no row.

Fields of a table are expanded and aggregated together, so the counting rules
take one scan of a table and the value rules another, however many fields and
rules there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.operators.sampling import sample_values
from stagetally.schemas import (
    DEFAULT_SEVERITY_WEIGHT,
    EMAIL_FIELDS,
    EMAIL_PATTERN,
    FACT_TABLES,
    ISSUES,
    LOWERCASE_FIELDS,
    RELATIONSHIPS,
    REQUIRED_FIELDS,
    SEVERITY_WEIGHTS,
    UNIQUE_KEYS,
    URL_FIELDS,
)
from stagetally.session import literal_table

Tables = Mapping[str, DataFrame]

# Advice per issue type, in report order.
ADVICE = {
    "blank_reference_field": "Store missing references as NULL instead of an empty string",
    "orphaned_reference": "Load the missing referenced records or clear the dangling references",
    "missing_required_field": "Find out why the source delivers records without required values",
    "duplicate_records": "Deduplicate the records and enforce the unique key on load",
    "invalid_format": "Validate value formats when records are loaded",
    "case_normalization": "Lower-case these values when records are loaded",
    "anomalous_distribution": "Check the snapshots whose size is far from the average",
    "missing_table": "Create the table or correct the folder that was audited",
}
NO_ADVICE = "No action needed; keep running the checks"


def _union(parts: list[DataFrame], schema=ISSUES) -> DataFrame:
    if not parts:
        return literal_table(SparkSession.getActiveSession(), [], schema)
    return reduce(DataFrame.unionByName, parts)


def _issue_rows(df: DataFrame, issue_type: str, severity: str, description: Column) -> DataFrame:
    return df.select(
        F.col("table"),
        F.col("field"),
        F.lit(issue_type).alias("issue_type"),
        F.col("count").cast("bigint").alias("count"),
        F.lit(severity).alias("severity"),
        description.alias("description"),
        F.col("sample_values"),
    )


def _counters(tables: Tables, rules: Mapping[str, tuple]) -> DataFrame:
    """Rows that satisfy each rule, one scan per table: (rule, table, field, count).

    ``rules`` maps a rule name to its fields per table and to the SQL test for
    text fields and for other fields.
    """
    parts = []
    for table, df in tables.items():
        sums = {}
        for rule, (fields, text_test, other_test) in rules.items():
            for f in fields.get(table, []):
                is_text = isinstance(df.schema[f].dataType, T.StringType)
                test = (text_test if is_text else other_test).format(c=f)
                sums[f"{rule}|{table}|{f}"] = f"coalesce(sum(CASE WHEN {test} THEN 1 ELSE 0 END), 0)"
        if sums:
            counted = df.selectExpr(*[f"{e} AS `{n}`" for n, e in sums.items()])
            parts.append(counted.unpivot([], [f"`{n}`" for n in sums], "_rule", "count"))
    counted = _union(parts, schema="_rule string, count bigint")
    named = F.split("_rule", r"\|")
    return counted.select(*[named[i].alias(c) for i, c in enumerate(("rule", "table", "field"))], "count")


def _rule_table(tables: Tables, rules: Mapping[str, tuple]) -> list[tuple[str, str, str, str, str]]:
    """(number, rule, table, field, target) of every rule that applies."""
    applied = [
        (rule, table, f, target)
        for table in tables
        for rule, (fields, _) in rules.items()
        for f, target in fields.get(table, {}).items()
    ]
    return [(str(i), *r) for i, r in enumerate(applied)]


def _offending(tables: Tables, rules: Mapping[str, tuple], numbered: list[tuple]) -> DataFrame:
    """Counts of values that satisfy each rule: (number, value, n).

    One scan per table: its fields are expanded, filtered and counted together.
    The partial aggregate collapses a value shared by many rows before the
    shuffle.  NULL and blank values never count.
    """
    parts = []
    for table, df in tables.items():
        columns = {
            number: f"CASE WHEN {f} <> '' AND {rules[rule][1].format(c=f)} THEN {f} END AS `{number}`"
            for number, rule, of, f, _ in numbered
            if of == table
        }
        if columns:
            wide = df.selectExpr(*columns.values()).unpivot([], [f"`{n}`" for n in columns], "number", "value")
            parts.append(wide.filter("value IS NOT NULL"))
    counted = _union(parts, schema="number string, value string")
    return counted.groupBy("number", "value").agg(F.count(F.lit(1)).alias("n"))


def missing_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """An issue for every table that should have been there."""
    rows = literal_table(
        spark,
        [(n, "*", 1, [n]) for n in names],
        "table string, field string, count bigint, sample_values array<string>",
    )
    return _issue_rows(rows, "missing_table", "critical", F.concat(F.lit("There is no table "), F.col("table")))


def _with_samples(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows per key plus the first five distinct values."""
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("count"))
    return totals.join(sample_values(counted, keys, "value", count="n"), keys)


# -- the checks -------------------------------------------------------------------------------


_BLANK = {t: list(fields) for t, fields in RELATIONSHIPS.items()}
_TARGETS = {
    t: {f: f"{ref}.{ref_field}" for f, (ref, ref_field) in fields.items()}
    for t, fields in RELATIONSHIPS.items()
}
_EMAILS = {t: dict.fromkeys(fields, "") for t, fields in EMAIL_FIELDS.items()}
_LOWERED = {
    t: dict.fromkeys(fields + URL_FIELDS.get(t, []), "") for t, fields in LOWERCASE_FIELDS.items()
}

# Rules that only count rows: (fields per table, test for text, test for other types).
COUNTER_RULES = {
    "blank_reference_field": (_BLANK, "{c} = ''", "false"),
    "missing_required_field": (REQUIRED_FIELDS, "({c} IS NULL OR {c} = '')", "{c} IS NULL"),
}
# Rules that also show values: ({table: {field: target}}, test).
VALUE_RULES = {
    "orphaned_reference": (_TARGETS, "true"),
    "invalid_format": (_EMAILS, f"NOT {{c}} RLIKE r'{EMAIL_PATTERN.replace('{', '{{').replace('}', '}}')}'"),
    "case_normalization": (_LOWERED, "{c} <> lower({c})"),
}
_SEVERITY = {
    "blank_reference_field": "warning",
    "missing_required_field": "critical",
    "orphaned_reference": "critical",
    "invalid_format": "warning",
    "case_normalization": "warning",
}


def counter_issues(tables: Tables, rules: Iterable[str] = tuple(COUNTER_RULES)) -> DataFrame:
    """Issues of the counting rules, one scan per table for all of them."""
    return counter_issue_rows(_counters(tables, {r: COUNTER_RULES[r] for r in rules}))


def counter_issue_rows(found: DataFrame) -> DataFrame:
    """Issues from counts (rule, table, field, count)."""
    found = found.filter("count > 0")
    blank = F.col("rule") == "blank_reference_field"
    samples = (
        F.when(blank, F.array(F.lit("''")))
        .when(F.col("table") == "snapshot_registry", F.array(F.lit("NULL")))
        .otherwise(F.array(F.lit("NULL"), F.lit("''")))
    )
    text = F.when(blank, F.concat(F.lit("Empty string in "), "field", F.lit(" should be NULL"))).otherwise(
        F.concat(F.lit("Required field "), "field", F.lit(" is NULL or blank"))
    )
    return _rule_issues(found.withColumn("sample_values", samples), text)


def value_issues(tables: Tables, rules: Iterable[str] = tuple(VALUE_RULES)) -> DataFrame:
    """Issues of the value rules, one scan per table for all of them.

    References are reduced to one row per value before the anti join and their
    targets to distinct keys; all relationships go through the same join.
    """
    usable = {r: _present(VALUE_RULES[r], tables) for r in rules}
    numbered = _rule_table(tables, usable)
    targets = {r[4] for r in numbered if r[4]}
    return value_issue_rows(_offending(tables, usable, numbered), numbered, _target_keys(tables, targets))


def value_issue_rows(counted: DataFrame, numbered: list[tuple], keys: DataFrame) -> DataFrame:
    """Issues from counts of offending values (number, value, n) of numbered rules, and the keys of referenced tables."""
    targets = {r[0]: r[4] for r in numbered if r[4]}
    if targets:
        # Values of the other rules have an empty target, so they pass the anti join.
        target = F.lit("")
        for number, name in targets.items():
            target = F.when(F.col("number") == number, name).otherwise(target)
        counted = counted.withColumn("target", target).join(keys, ["target", "value"], "left_anti")
    return numbered_issue_rows(_with_samples(counted, ["number"]), numbered)


def numbered_issue_rows(found: DataFrame, numbered: list[tuple]) -> DataFrame:
    """Issues from totals and samples of numbered rules (number, count, sample_values)."""
    names = literal_table(
        SparkSession.getActiveSession(),
        numbered,
        "number string, rule string, table string, field string, target string",
    )
    orphan = F.col("rule") == "orphaned_reference"
    text = (
        F.when(orphan, F.concat("field", F.lit(" values without a row in "), "target"))
        .when(F.col("rule") == "invalid_format", F.concat(F.lit("Not an e-mail address in "), "field"))
        .otherwise(F.concat("field", F.lit(" should be lower case")))
    )
    return _rule_issues(found.join(names, "number"), text)


def _present(rule: tuple, tables: Tables) -> tuple:
    """The rule without references to tables that are absent."""
    fields, test = rule
    kept = {
        t: {f: target for f, target in by_field.items() if not target or target.split(".")[0] in tables}
        for t, by_field in fields.items()
    }
    return kept, test


def _target_keys(tables: Tables, targets: Iterable[str]) -> DataFrame:
    """Distinct keys of the referenced tables: (target, value)."""
    parts = []
    for target in sorted(targets):
        table, field = target.split(".")
        parts.append(tables[table].select(F.lit(target).alias("target"), F.col(field).alias("value")))
    return _union(parts, schema="target string, value string").distinct()


def _rule_issues(found: DataFrame, description: Column) -> DataFrame:
    severity = F.lit(None).cast("string")
    for rule, level in _SEVERITY.items():
        severity = F.when(F.col("rule") == rule, level).otherwise(severity)
    return found.select(
        "table",
        "field",
        F.col("rule").alias("issue_type"),
        F.col("count").cast("bigint").alias("count"),
        severity.alias("severity"),
        description.alias("description"),
        "sample_values",
    )


def blank_reference_count(tables: Tables) -> DataFrame:
    """Reference fields that hold an empty string instead of NULL."""
    return counter_issues(tables, ["blank_reference_field"])


def missing_required_count(tables: Tables) -> DataFrame:
    """Required fields that are NULL or blank (a timestamp can only be NULL)."""
    return counter_issues(tables, ["missing_required_field"])


def orphan_references(tables: Tables) -> DataFrame:
    """Reference values without a row in the table they point to."""
    return value_issues(tables, ["orphaned_reference"])


def invalid_format_count(tables: Tables) -> DataFrame:
    """E-mail fields that do not look like an address; NULL and blank are ignored."""
    return value_issues(tables, ["invalid_format"])


def case_violation_count(tables: Tables) -> DataFrame:
    """Values that should be lower case, over all 13 fields."""
    return value_issues(tables, ["case_normalization"])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per unique key.

    Keys are nearly all different, so a partial count before the shuffle would
    only fill memory, and they compress so well that partitions merged by size
    hold many millions of them.  The rows are dealt into the session's number
    of shuffle partitions instead, which are not merged.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*keys).repartition(parts, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return key_counts(df, keys).filter("n > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of duplicated keys and of surplus rows."""
    return duplicate_groups(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("duplicate_records"),
    )


def duplicate_records(tables: Tables, unique_keys: Mapping[str, list[str]] = UNIQUE_KEYS) -> DataFrame:
    parts = [
        duplicate_summary(tables[t], keys).select(
            F.lit(t).alias("table"),
            F.lit(f"({', '.join(keys)})").alias("field"),
            F.col("duplicate_records").alias("count"),
            "duplicate_groups",
        )
        for t, keys in unique_keys.items()
        if t in tables
    ]
    return duplicate_issue_rows(_union(parts)) if parts else _union([])


def duplicate_issue_rows(found: DataFrame) -> DataFrame:
    """Issues from surplus rows and duplicated keys (table, field, count, duplicate_groups)."""
    groups = F.col("duplicate_groups").cast("string")
    found = found.filter("duplicate_groups > 0")
    found = found.withColumn("sample_values", F.array(F.concat(groups, F.lit(" duplicate groups"))))
    text = F.concat(groups, F.lit(" keys are held by more than one row"))
    return _issue_rows(found, "duplicate_records", "critical", text)


def unregistered_snapshots(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Snapshot ids in a fact table that the registry does not know."""
    return fact.select("snapshot_id").distinct().join(
        registry.select("snapshot_id").distinct(), "snapshot_id", "left_anti"
    )


def registered_without_data(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Snapshot ids in the registry without a row in a fact table."""
    return unregistered_snapshots(registry, fact)


def snapshot_consistency(tables: Tables) -> DataFrame:
    """Both directions for every fact table; a single issue if the registry is empty.

    Every table is reduced to its snapshot ids, and one aggregate over their
    union tells which table knows which id.
    """
    if "snapshot_registry" not in tables:
        return _union([])
    facts = [t for t in FACT_TABLES if t in tables]
    ids = _union(
        [
            tables[t].select(F.col("snapshot_id").cast("string").alias("value")).distinct().withColumn("of", F.lit(t))
            for t in ("snapshot_registry", *facts)
        ]
    )
    return consistency_issue_rows(ids, facts)


def consistency_issue_rows(ids: DataFrame, facts: list[str]) -> DataFrame:
    """Issues from the distinct snapshot ids (value) of each table (of)."""
    known = ids.filter("value IS NOT NULL").groupBy("value").agg(
        *[F.bool_or(F.col("of") == t).alias(t) for t in ("snapshot_registry", *facts)]
    )
    registered = F.col("snapshot_registry")
    cases = [
        F.when(registered != F.col(t), F.struct(
            F.lit(t).alias("table"),
            F.when(registered, "missing_snapshot_data").otherwise("unregistered_snapshot").alias("issue_type"),
        ))
        for t in facts
    ]
    empty = ids.filter("of = 'snapshot_registry'").agg(F.count("value").alias("n"))
    issues = [
        empty.filter("n = 0").select(
            F.lit("snapshot_registry").alias("table"),
            F.lit("snapshot_id").alias("field"),
            F.lit("missing_snapshots").alias("issue_type"),
            F.lit(0).cast("bigint").alias("count"),
            F.lit("critical").alias("severity"),
            F.lit("The registry holds no snapshot").alias("description"),
            F.array().cast("array<string>").alias("sample_values"),
        )
    ]
    if facts:
        found = known.select("value", F.lit(1).alias("n"), F.inline(F.array_compact(F.array(*cases))))
        found = _with_samples(found, ["table", "issue_type"]).filter(empty.scalar() > 0)
        missing = F.col("issue_type") == "missing_snapshot_data"
        issues.append(
            found.select(
                "table",
                F.lit("snapshot_id").alias("field"),
                "issue_type",
                F.col("count").cast("bigint").alias("count"),
                F.when(missing, "info").otherwise("warning").alias("severity"),
                F.when(missing, "Registered snapshots without a row in the table")
                .otherwise("Snapshots in the table that are not registered")
                .alias("description"),
                "sample_values",
            )
        )
    return _union(issues)


def snapshot_distribution(companies: DataFrame, deals: DataFrame) -> DataFrame:
    """Distinct companies and deals per snapshot.

    Counted from rows per (id, snapshot): no task sees all ids of a snapshot,
    and in an audit the duplicate check shares that shuffle (the test on the
    count keeps both plans alike).
    """

    def present(df, field, kind):
        keyed = key_counts(df, [field, "snapshot_id"])
        one = F.when(F.col(field).isNotNull() & (F.col("n") > 0), 1).otherwise(0)
        zero = F.lit(0)
        return keyed.select(
            "snapshot_id",
            (one if kind == "companies" else zero).alias("companies"),
            (one if kind == "deals" else zero).alias("deals"),
        )

    both = present(companies, "company_id", "companies").unionByName(present(deals, "deal_id", "deals"))
    return both.groupBy("snapshot_id").agg(
        F.sum("companies").alias("companies"), F.sum("deals").alias("deals")
    )


def distribution_anomalies(distribution: DataFrame) -> DataFrame:
    """Snapshots below 50 % or above 200 % of the mean, if there are two or more."""
    # The means are one row; as a scalar they reach every task without gathering the snapshots in one.
    means = F.struct(F.count(F.lit(1)).alias("snapshots"), *[F.avg(t).alias(t) for t in FACT_TABLES])
    sized = distribution.withColumn("_all", distribution.agg(means.alias("all")).scalar())
    per_table = [
        F.struct(F.lit(t).alias("table"), F.col(t).cast("bigint").alias("count"), F.col("_all")[t].alias("mean"))
        for t in FACT_TABLES
    ]
    rows = sized.filter("_all.snapshots > 1").select("snapshot_id", F.inline(F.array(*per_table)))
    ratio = F.when(F.col("mean") > 0, F.col("count") / F.col("mean")).otherwise(0.0)
    found = rows.filter((ratio < 0.5) | (ratio > 2.0)).withColumns(
        {
            "field": F.lit("snapshot_id"),
            "snapshot": F.col("snapshot_id").cast("string"),
            "sample_values": F.array(F.col("snapshot_id").cast("string")),
        }
    )
    text = F.concat(
        F.lit("Snapshot "),
        "snapshot",
        F.lit(" has "),
        F.col("count").cast("string"),
        F.lit(" rows, the mean is "),
        F.format_string("%.0f", "mean"),
    )
    return _issue_rows(found, "anomalous_distribution", "warning", text)


# -- summaries ----------------------------------------------------------------------------------


def issue_rollup(issues: DataFrame) -> DataFrame:
    """Number of issues in all and by severity, table and type."""
    rolled = issues.groupingSets(
        [[], [F.col("severity")], [F.col("table")], [F.col("issue_type")]],
        F.col("severity"),
        F.col("table"),
        F.col("issue_type"),
    ).agg(F.count(F.lit(1)).alias("issues"), F.grouping_id().alias("_set"))
    kind = (
        F.when(F.col("_set") == 3, "severity")
        .when(F.col("_set") == 5, "table")
        .when(F.col("_set") == 6, "issue_type")
        .otherwise("total")
    )
    return rolled.select(
        kind.alias("dimension"),
        F.coalesce("severity", "table", "issue_type", F.lit("all")).alias("value"),
        "issues",
    )


def integrity_score(issues: DataFrame, counts: DataFrame) -> DataFrame:
    """0 to 100: one hundred minus the weighted share of affected rows."""
    weight = F.lit(DEFAULT_SEVERITY_WEIGHT)
    for severity, value in SEVERITY_WEIGHTS.items():
        weight = F.when(F.col("severity") == severity, value).otherwise(weight)
    penalty = issues.agg(F.coalesce(F.sum(F.col("count") * weight), F.lit(0.0)).alias("penalty"))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("total_records"))
    share = F.col("penalty") / F.col("total_records") * 100
    score = F.when(F.col("total_records") == 0, 0.0).otherwise(
        F.round(F.greatest(F.lit(0.0), 100 - share), 2)
    )
    return total.select("total_records", penalty.scalar().alias("penalty")).select(
        "total_records", score.alias("integrity_score")
    )


def recommendations(issues: DataFrame) -> DataFrame:
    """Advice for the issue types present, or one default row."""
    spark = issues.sparkSession
    advice = literal_table(
        spark,
        [(i, t, a) for i, (t, a) in enumerate(ADVICE.items(), 1)],
        "position bigint, issue_type string, recommendation string",
    )
    found = advice.join(issues.select("issue_type").distinct(), "issue_type", "left_semi")
    nothing = found.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    default = nothing.select(
        F.lit(None).cast("string").alias("issue_type"),
        F.lit(0).cast("bigint").alias("position"),
        F.lit(NO_ADVICE).alias("recommendation"),
    )
    return found.unionByName(default)
