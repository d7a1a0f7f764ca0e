"""Rule files as tables and as rule lists.

Rule text is configuration written by people. It is read with Spark, one row for each line, checked there,
and only the accepted rules come to the driver, because they become column expressions.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.operators.rule_checks import generic_errors, java_fault, json_error, lint_generic_errors, regex_error
from tallybook.schemas import GENERIC_RULE

def rule_lines(spark: SparkSession, directory: str, pattern: str = "*.ndjson") -> DataFrame:
    """Lines of the rule files of a directory: file, line (from 1), text (stripped)."""
    files = spark.read.option("pathGlobFilter", pattern).text(directory, wholetext=True)
    return files.select(
        # The path is an URL, where a plus stands for itself.
        F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.posexplode(F.split("value", "\r?\n")).alias("at", "text"),
    ).select("file", (F.col("at") + 1).alias("line"), F.trim(F.col("text"), F.lit(" \t\r\f\x0b")).alias("text"))


def _field(name: str) -> Column:
    return F.get_json_object("text", f"$.{name}")


def simple_rules(lines: DataFrame) -> DataFrame:
    """First-match rules from lines, with defaults and one ``error`` column (NULL for a good rule).

    Blank lines and ``#`` comments are no rules. Order of application: (file, line).
    """
    stem = F.regexp_replace("file", r"\.[^.]+$", "")
    fields = lines.filter((F.col("text") != "") & ~F.col("text").startswith("#")).select(
        "file",
        "line",
        F.coalesce(_field("id"), F.concat_ws(":", stem, F.col("line").cast("string"))).alias("id"),
        F.coalesce(_field("column"), F.lit("name")).alias("column"),
        F.coalesce(_field("op"), F.lit("regex")).alias("op"),
        _field("value").alias("value"),
        _field("category").alias("category"),
        _field("subcategory").alias("subcategory"),
        json_error(F.col("text")).alias("json_error"),
    )
    bad_json = F.when(
        F.col("json_error").isNotNull(), F.concat(F.lit("invalid JSON: "), F.col("json_error"))
    )
    bad_op = F.when(F.lower("op") != "regex", F.concat(F.lit("only op 'regex' is supported, got: "), F.col("op")))
    no_value = F.when(F.col("value").isNull(), F.lit("missing field: value"))
    bad_regex = F.concat(F.lit("regex does not compile: "), regex_error(F.col("value")))
    not_for_java = F.concat(F.lit("pattern is not for Java: "), java_fault(fields, "value"))
    return fields.select(
        "file", "line", "id", "column", "op", "value", "category", "subcategory",
        F.coalesce(bad_json, bad_op, no_value, bad_regex, not_for_java).alias("error"),
    )


def generic_rules(lines: DataFrame) -> DataFrame:
    """Priority rules from lines: (file, line, rule, error), all lines that are not blank."""
    parsed = lines.filter(F.col("text") != "").select(
        "file", "line", "text", F.from_json("text", GENERIC_RULE).alias("rule")
    )
    errors = generic_errors(F.col("text"))
    return parsed.select(
        "file", "line", "text",
        F.col("rule").withField("logic", F.lower("rule.logic")).alias("rule"),
        F.get(errors, F.lit(0)).alias("error"),
    )


def latest_rules(rules: DataFrame, key: str = "id") -> DataFrame:
    """The last read rule of each id, by (file, line). The row number filter becomes a group limit."""
    newest = Window.partitionBy(key).orderBy(F.desc("file"), F.desc("line"))
    return rules.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def _reject(rows: list[Any]) -> None:
    bad = [f"{r.file}:{r.line} {r.error}" for r in rows if r.error is not None]
    if bad:
        raise ValueError("; ".join(bad))


def load_simple_rules(spark: SparkSession, directory: str, pattern: str = "*.ndjson") -> list[dict[str, Any]]:
    """Rules for ``categorize``. Any rejected line is an error."""
    rows = simple_rules(rule_lines(spark, directory, pattern)).orderBy("file", "line").collect()
    _reject(rows)
    return [
        {k: r[k] for k in ("id", "column", "op", "value", "category", "subcategory")} for r in rows
    ]


def load_generic_rules(spark: SparkSession, directory: str, pattern: str = "*.ndjson") -> list[dict[str, Any]]:
    """Rules for ``apply_priority_rules``, in (priority, id) order, last one read winning for each id."""
    read = generic_rules(rule_lines(spark, directory, pattern))
    _reject(read.filter(F.col("error").isNotNull()).orderBy("file", "line").collect())
    _reject(lint_generic_errors(read).select("file", "line", F.col("detail").alias("error")).orderBy("file", "line").collect())
    rows = (
        latest_rules(read.select("file", "line", "text", F.col("rule.id").alias("id"), "rule.priority"))
        .orderBy("priority", "id")
        .collect()
    )
    # From the text, not from the parsed columns: literals keep their JSON types.
    return [{**rule, "logic": str(rule["logic"]).lower()} for rule in (json.loads(r.text) for r in rows)]


def load_rules_yaml(path: str, spark: SparkSession | None = None) -> list[dict[str, Any]]:
    """Priority rules from a YAML file with a top-level ``rules`` list, in any store if a session is given."""
    return (read_yaml(path, spark) or {}).get("rules", [])


def read_yaml(path: str, spark: SparkSession | None = None) -> Any:
    """A configuration file, read where the driver is or, with a session, by Spark from any store."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML needs PyYAML; NDJSON rules do not") from missing
    if spark is not None:
        return yaml.safe_load("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def rules_table(spark: SparkSession, rules: list[dict[str, Any]]) -> DataFrame:
    """Priority rules as a DataFrame with the GENERIC_RULE layout (literals as JSON text)."""

    def text(v: Any) -> str | None:
        return v if v is None or isinstance(v, str) else json.dumps(v)

    def plain(rule: dict[str, Any]) -> dict[str, Any]:
        return {
            "id": rule.get("id"),
            "priority": int(rule.get("priority", 1000)),
            "logic": str(rule.get("logic") or "all").lower(),
            "match": [
                {
                    "column": p["column"],
                    "op": p["op"],
                    "value": text(p.get("value")),
                    "values": None if p.get("values") is None else [text(v) for v in p["values"]],
                    "case_insensitive": bool(p.get("case_insensitive", False)),
                }
                for p in rule.get("match") or []
            ],
            "actions": [
                {"set": {"target": a["set"]["target"], "value": text(a["set"]["value"])}}
                for a in rule.get("actions") or []
                if a.get("set")
            ],
            "stop_after_match": bool(rule.get("stop_after_match", False)),
            "profiles": rule.get("profiles"),
        }

    return spark.createDataFrame([plain(r) for r in rules], GENERIC_RULE)
