"""Data contract of the raw extract and integrity checks of the warehouse tables.

Spark enforces no keys or value limits on parquet, so every rule is an operator returning what
breaks it. All of them are single scans with map-side combined counts.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tenura.functions import domain as D
from tenura.functions.features import strip

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


class ContractError(Exception):
    """The extract breaks the contract."""


@dataclass
class Report:
    rows: int
    errors: list[str]
    warnings: list[str]

    @property
    def ok(self) -> bool:
        return not self.errors


def check_required_columns(df: DataFrame, required=tuple(D.RAW_COLUMNS)) -> list[str]:
    """Missing columns; metadata only, no job."""
    return [c for c in required if c not in df.columns]


def check_unique_key(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows repeat a key (rows - distinct keys)."""
    return df.groupBy(key).agg(F.count("*").alias("n")) \
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"))


def domain_table(spark: SparkSession, domains: dict[str, list[str]]) -> DataFrame:
    pairs = [(c, v) for c, values in domains.items() for v in values]
    return spark.createDataFrame(pairs, "column_name string, value string")


def check_domains(df: DataFrame, domains: dict[str, list[str]] = D.RAW_DOMAINS) -> DataFrame:
    """Values outside the allowed set, per column, with their row count.

    One pass over the extract for all columns: unpivot, count per (column, value), then an anti-join
    with the allowed values (a fixed table of a few dozen rows).
    """
    tall = df.select([strip(F.col(c).cast("string")).alias(c) for c in domains]) \
        .unpivot([], list(domains), "column_name", "value")
    seen = tall.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    allowed = domain_table(df.sparkSession, domains)
    return seen.join(F.broadcast(allowed), ["column_name", "value"], "left_anti")   # fixed values only


def number(column: str) -> Column:
    """The column as a number, null when it is not one ('5d', 'nan' and blanks are not)."""
    text = strip(F.col(column).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def check_numeric_parse(df: DataFrame, columns=tuple(D.RAW_NUMBERS)) -> DataFrame:
    """Per column: values that are no number, and negative ones."""
    one = df.agg(*[F.count_if(number(c).isNull()).alias(f"bad_{c}") for c in columns],
                 *[F.count_if(number(c) < 0).alias(f"neg_{c}") for c in columns])
    stack = ", ".join(f"'{c}', bad_{c}, neg_{c}" for c in columns)
    return one.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, non_numeric, negative)")


def check_non_negative(df: DataFrame, columns=tuple(D.RAW_NUMBERS)) -> DataFrame:
    return check_numeric_parse(df, columns).select("column_name", "negative")


def check_conditional_blank(df: DataFrame, column: str = "TotalCharges", tenure: str = "tenure") -> DataFrame:
    """Unparsable totals: allowed where tenure is 0 (warning), an error anywhere else."""
    bad = number(column).isNull()
    excused = F.coalesce(number(tenure) == 0, F.lit(False))
    return df.agg(F.count_if(bad & excused).alias("excused"), F.count_if(bad & ~excused).alias("not_excused"))


def check_rate_drift(df: DataFrame, column: str = "Churn", limits=D.EXPECTED_CHURN_RATE) -> DataFrame:
    low, high = limits
    rate = F.try_divide(F.count_if(F.col(column) == "Yes").cast("double"), F.count("*").cast("double"))
    return df.agg(rate.alias("rate")).withColumn(
        "off", ~F.coalesce((F.col("rate") > low) & (F.col("rate") < high), F.lit(False)))


def validation_report(df: DataFrame) -> DataFrame:
    """All contract findings as rows (check, column, severity, n); no rows means a clean extract."""
    missing = check_required_columns(df)
    if missing:
        return df.sparkSession.createDataFrame(
            [("required_columns", c, "error", 1) for c in missing],
            "check_name string, column_name string, severity string, n bigint")

    def finding(frame, check, column, severity, n):
        return frame.select(F.lit(check).alias("check_name"), column.alias("column_name"),
                            F.lit(severity).alias("severity"), n.cast("bigint").alias("n"))

    # everything that needs no grouping comes from one scan
    low, high = D.EXPECTED_CHURN_RATE
    bad_total, new = number("TotalCharges").isNull(), F.coalesce(number("tenure") == 0, F.lit(False))
    rate = F.try_divide(F.count_if(F.col("Churn") == "Yes").cast("double"), F.count("*").cast("double"))
    excused, not_excused = F.count_if(bad_total & new), F.count_if(bad_total & ~new)

    def item(check, column, severity, n):
        return F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
                        F.lit(severity).alias("severity"), n.cast("bigint").alias("n"))

    none = F.lit(0).cast("bigint")
    single = df.agg(F.array(
        *[item("numeric", c, "error", F.count_if(number(c).isNull())) for c in D.RAW_NUMBERS if c != "TotalCharges"],
        *[item("negative", c, "error", F.count_if(number(c) < 0)) for c in D.RAW_NUMBERS],
        # any total that is not excused by tenure 0 makes all unparsable totals an error
        item("numeric", "TotalCharges", "error", F.when(not_excused > 0, excused + not_excused).otherwise(none)),
        item("blank_total", "TotalCharges", "warning", F.when(not_excused == 0, excused).otherwise(none)),
        item("churn_rate", "Churn", "warning",
             (~F.coalesce((rate > low) & (rate < high), F.lit(False))).cast("bigint")),
    ).alias("found")).select(F.explode("found").alias("f")).select("f.*")
    rows = [
        finding(check_unique_key(df, D.RAW_KEY), "unique_key", F.lit(D.RAW_KEY), "error", F.col("repeats")),
        finding(check_domains(df).groupBy("column_name").agg(F.count("*").alias("n")),
                "domain", F.col("column_name"), "error", F.col("n")),
        single,
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.where(F.col("n") > 0)


def validate(df: DataFrame, strict: bool = True) -> Report:
    """Run the contract. Findings are at most a few per column, so they fit the driver."""
    found = [] if check_required_columns(df) else [df.count()]
    lines = {"error": [], "warning": []}
    for f in validation_report(df).collect():
        lines[f.severity].append(f"{f.column_name}: {f.check_name} ({f.n})")
    report = Report(found[0] if found else 0, sorted(lines["error"]), sorted(lines["warning"]))
    if strict and report.errors:
        raise ContractError("; ".join(report.errors))
    return report


# ---------------------------------------------------------------- warehouse tables
def check_primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per required column, one scan."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "nulls")


def check_value_in(df: DataFrame, column: str, allowed: list) -> DataFrame:
    return df.agg(F.count_if(~F.col(column).isin(*allowed)).alias("outside"))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows without a parent (nulls do not count, as in SQL)."""
    keys = parent.select(F.col(parent_column).alias("_key"))
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def reconcile_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table and whether it equals the first one's; `reconcile` fails where it does not."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n",
                                                    F.lit(i == 0).alias("_base"))
             for i, (name, df) in enumerate(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    first = F.max(F.when(F.col("_base"), F.col("n"))).over(Window.partitionBy(F.lit(0)))   # one row per table
    return out.select("table_name", "n", (F.col("n") == first).alias("matches"))


def reconcile(tables: dict[str, DataFrame]) -> None:
    """Stop a load that lost or repeated rows on the way."""
    off = [f"{r.table_name}: {r.n}" for r in reconcile_row_counts(tables).where("NOT matches").collect()]
    if off:
        raise ContractError("row counts differ from the first table: " + "; ".join(sorted(off)))


def _given(tables: dict[str, DataFrame], name: str) -> DataFrame:
    if name not in tables:
        raise ContractError(f"table {name} is not given")
    return tables[name]


def check_relationship(tables: dict[str, DataFrame], relationships=D.RELATIONSHIPS) -> DataFrame:
    """Per declared relationship: repeated keys on the one side(s) and orphans on the many side.

    Each table is scanned once. The keys of all relationships and both sides meet in one count per (relationship, key),
    summed before the shuffle, so a hot key sends one row per task. Keys are compared as text; null keys are no orphans.
    A table that is not given is an error.
    """
    sides: dict[str, list] = {}
    for i, (child, column, parent, parent_column, _) in enumerate(relationships):
        for table, key, side in ((child, column, "child"), (parent, parent_column, "parent")):
            _given(tables, table)
            sides.setdefault(table, []).append(F.struct(
                F.lit(i).alias("at"), F.col(key).cast("string").alias("key"), F.lit(side).alias("side")))
    keys = [tables[t].select(F.explode(F.array(*found)).alias("k")).select("k.*") for t, found in sides.items()]
    counts = reduce(DataFrame.unionByName, keys).groupBy("at", "key").agg(
        F.count_if(F.col("side") == "child").alias("children"), F.count_if(F.col("side") == "parent").alias("parents"))
    problems = []
    for i, (child, column, parent, parent_column, kind) in enumerate(relationships):
        here = F.col("at") == i
        lost = here & F.col("key").isNotNull() & (F.col("parents") == 0)
        found = {"parent_not_unique": F.count_if(here & (F.col("parents") > 1)),
                 "orphans": F.coalesce(F.sum(F.when(lost, F.col("children"))), F.lit(0))}
        if kind == "one_to_one":
            found["child_not_unique"] = F.count_if(here & (F.col("children") > 1))
        name = F.lit(f"{child}.{column} -> {parent}.{parent_column}")
        problems += [F.struct(name.alias("relationship"), F.lit(problem).alias("problem"), n.cast("bigint").alias("n"))
                     for problem, n in found.items()]
    return counts.agg(F.array(*problems).alias("found")).select(F.explode("found").alias("f")).select("f.*")


def check_bridge_cardinality(bridge: DataFrame, key: str = "customer_id", expected: int = len(D.ADDONS)) -> DataFrame:
    """Customers whose number of bridge rows is not the expected one."""
    return bridge.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") != expected)


def check_table_rules(tables: dict[str, DataFrame], rules=D.TABLE_RULES) -> DataFrame:
    """All declared key, null and value rules of the given tables: (table, rule, n)."""
    out = None
    for name, rule in rules.items():
        df = _given(tables, name)
        parts = [check_primary_key(df, keys).agg(F.count("*").alias("n"))
                 .select(F.lit(f"unique {', '.join(keys)}").alias("rule"), "n") for keys in rule["unique"]]
        # null and value rules of a table share one scan
        rules_here = [(f"not null {c}", F.col(c).isNull()) for c in rule["required"]]
        rules_here += [(f"0/1 {c}", ~F.col(c).isin(0, 1)) for c in rule.get("binary", [])]
        found = df.agg(F.array(*[F.struct(F.lit(label).alias("rule"), F.count_if(broken).alias("n"))
                                 for label, broken in rules_here]).alias("found"))
        parts.append(found.select(F.explode("found").alias("f")).select("f.*"))
        for p in parts:
            p = p.select(F.lit(name).alias("table_name"), "rule", "n")
            out = p if out is None else out.unionByName(p)
    return out
