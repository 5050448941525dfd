"""Validation of a table by the schema in a package descriptor.

The descriptor's fields (name, type, constraints) and primary key are compiled to expressions: all rules on single values
are counted in one aggregation over the table, and each rule on keys in one grouping with map-side combine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's types for the type names of descriptors.
TYPES = {
    "integer": "BIGINT", "number": "DOUBLE", "boolean": "BOOLEAN", "string": "STRING", "date": "DATE", "datetime": "TIMESTAMP", "year": "INT",
}
RESULT = "field STRING, rule STRING, n_bad BIGINT, least_key STRING"


def _name(field: str) -> str:
    return "`" + field.replace("`", "``") + "`"


def value_rules(schema: dict) -> list[tuple[str, str, Column]]:
    """``(field, rule, is bad)`` for every rule of a descriptor's schema that looks at one value; null breaks ``required`` alone."""
    rules = []
    for field in schema.get("fields", ()):
        name, kind, rule = field["name"], field.get("type", "string"), field.get("constraints", {})
        if kind not in TYPES:
            raise ValueError(f"no such type: {kind}")
        raw = F.col(_name(name))
        value = F.expr(f"try_cast({_name(name)} AS {TYPES[kind]})")
        if kind != "string":
            rules.append((name, "type", raw.isNotNull() & value.isNull()))
        if rule.get("required"):
            rules.append((name, "required", raw.isNull()))
        if "minimum" in rule:
            rules.append((name, "minimum", value < F.lit(rule["minimum"])))
        if "maximum" in rule:
            rules.append((name, "maximum", value > F.lit(rule["maximum"])))
        if "minLength" in rule:
            rules.append((name, "minLength", F.length(raw.cast("string")) < rule["minLength"]))
        if "maxLength" in rule:
            rules.append((name, "maxLength", F.length(raw.cast("string")) > rule["maxLength"]))
        if "pattern" in rule:
            rules.append((name, "pattern", ~raw.cast("string").rlike(f"^(?:{rule['pattern']})$")))
        if "enum" in rule:
            rules.append((name, "enum", ~raw.cast("string").isin([str(v).lower() if isinstance(v, bool) else str(v) for v in rule["enum"]])))
    return rules


def key_rules(schema: dict) -> list[tuple[str, str, list[str]]]:
    """``(field, rule, columns)`` for the unique fields and the primary key."""
    rules = [(f["name"], "unique", [f["name"]]) for f in schema.get("fields", ()) if f.get("constraints", {}).get("unique")]
    key = schema.get("primaryKey")
    key = [key] if isinstance(key, str) else key
    return rules + ([(",".join(key), "primaryKey", list(key))] if key else [])


def validate(df: DataFrame, schema: dict) -> DataFrame:
    """``field, rule, n_bad, least_key``: rows that break each rule, and the least key among them as text.

    ``unique`` and ``primaryKey`` count the rows that share a key with another row; rows with a null in a unique field
    do not, and in a primary key they are bad. The key shown is the primary key, or else the first field. A field that
    the table lacks is one bad row of the rule ``present`` and has no other rule. An empty table breaks no rule.
    """
    there = {c.lower() for c in df.columns}
    lacking = [f["name"] for f in schema.get("fields", ()) if f["name"].lower() not in there]
    known = {**schema, "fields": [f for f in schema.get("fields", ()) if f["name"] not in lacking]}
    values, keys = value_rules(known), [k for k in key_rules(known) if all(c.lower() in there for c in k[2])]
    primary = next((c for _, r, c in keys if r == "primaryKey"), None) or [df.columns[0]]
    shown = F.concat_ws(",", *[F.col(_name(c)).cast("string") for c in primary])
    sums = [F.count_if(bad).alias(f"n{k}") for k, (_, _, bad) in enumerate(values)]
    least = [F.min(F.when(bad, shown)).alias(f"k{k}") for k, (_, _, bad) in enumerate(values)]
    rows = [F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"n{k}").alias("n_bad"), F.col(f"k{k}").alias("least_key")) for k, (f, r, _) in enumerate(values)]
    parts = [df.agg(*sums, *least).select(F.inline(F.array(*rows)))] if values else []
    for field, rule, columns in keys:
        named = [F.col(_name(c)) for c in columns]
        null = reduce(Column.__or__, [c.isNull() for c in named])
        # Rows with a null key meet in one group, which the map side folds to a row a task.
        groups = df.groupBy(*named).agg(F.count(F.lit(1)).alias("n"), F.min(shown).alias("least"))
        bad = (F.col("n") > 1) & ~null if rule == "unique" else (F.col("n") > 1) | null
        total = groups.agg(F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n_bad"), F.min(F.when(bad, F.col("least"))).alias("least_key"))
        parts.append(total.select(F.lit(field).alias("field"), F.lit(rule).alias("rule"), "n_bad", "least_key"))
    if lacking:
        parts.append(df.sparkSession.createDataFrame([(f, "present", 1, None) for f in lacking], RESULT))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], RESULT)
