"""Readers and writers: delimited extracts, warehouse tables, score upserts, BI extracts."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenura.functions import domain as D
from tenura.functions import features as X

KEEP_BLANKS = "\u0000"      # no cell holds this, so no cell turns into null


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_subscriptions(spark: SparkSession, path: str, columns=tuple(D.RAW_COLUMNS)) -> DataFrame:
    """Delimited extract with header, every column text, blanks kept as delivered.

    enforceSchema=False compares the header with the expected columns, so a file with swapped
    columns fails instead of being read wrongly.
    """
    cells = (spark.read.schema(text_schema(list(columns)))
             .option("header", True).option("enforceSchema", False)
             .option("nullValue", KEEP_BLANKS).option("emptyValue", "").csv(path))
    return cells.select([F.coalesce(c, F.lit("")).alias(c) for c in columns])   # an empty cell arrives as null


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Identity of a table's content, whatever the row order: row count and sums of both halves of the
    rows' md5. Every cell carries its length, and a null cell is marked apart from any text."""
    def cell(c):
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    rows = df.select(F.md5(F.concat(*[cell(c) for c in sorted(df.columns)])).alias("h"))
    halves = [F.conv(F.substring("h", at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return rows.agg(F.count("*").alias("n_rows"), F.concat_ws("-", *[
        F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").cast("string") for h in halves]).alias("fingerprint"))


COMMITS = "commits"
COMMIT_SCHEMA = "number bigint, version string, tables array<string>"


def star_commits(spark: SparkSession, folder: str) -> DataFrame:
    """The versions of a star: number, version (a folder below the star's), tables. Empty where nothing was committed."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{folder}/{COMMITS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def read_table(spark: SparkSession, folder: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the star that was committed last, or with that number; of the folder itself where there are no commits.

    The frame keeps reading the version it was opened on, whatever is committed later.
    """
    log = star_commits(spark, folder)
    chosen = (log if number is None else log.where(F.col("number") == number)).orderBy(F.desc("number"), F.desc("version")).first()
    if chosen is None and number is None:
        return spark.read.parquet(f"{folder}/{name}")
    if chosen is None or name not in chosen.tables:
        raise ValueError(f"{name} is in no committed star of {folder}" + (f" numbered {number}" if number is not None else ""))
    return spark.read.parquet(f"{folder}/{chosen.version}/{name}")


def query(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """Run parameterised SQL (:name markers) over the given tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params)


def write_clean(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_star(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace all tables of the star in one commit.

    The tables go into a new version folder; readers find it by the commit log, whose one new row is written last as one file.
    A load that fails before that leaves the old star as it was, and a star may be built from the one it replaces.
    Older versions stay for frames that still read them. One load at a time: of two with the same number, the
    one with the larger version name counts.
    """
    if not tables:
        raise ValueError("a star without tables")
    spark = next(iter(tables.values())).sparkSession
    version = f"version-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{version}/{name}")
    last = star_commits(spark, folder).agg(F.max("number")).first()[0]
    row = spark.createDataFrame([((last or 0) + 1, version, sorted(tables))], COMMIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/{COMMITS}")


def write_scores(scores: DataFrame, path: str) -> None:
    """Upsert by model: partitions of the models present are replaced, other models stay."""
    scores.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("model_name").parquet(path)


def write_insights(results: dict[str, DataFrame], folder: str) -> list[str]:
    """One delimited output per question; questions without rows are skipped. Returns what was written."""
    written = []
    for name, df in results.items():
        if not df.isEmpty():
            df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            written.append(name)
    return written


def export_bi(tables: dict[str, DataFrame], folder: str) -> None:
    """Delimited extract per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def bi_tables(star: dict[str, DataFrame], scores: DataFrame | None = None,
              segments: DataFrame | None = None) -> dict[str, DataFrame]:
    """What the BI layer reads: the star, and scores and segments where they exist."""
    out = dict(star)
    if scores is not None:
        out["fact_churn_score"] = scores
    if segments is not None:
        out["dim_segment"] = segments.select("customer_id", "segment_id", "segment_name")
    return out


_INT, _TEXT, _REAL = "bigint", "string", "double"
BI_TYPES = {
    "fact_subscription": {"customer_id": _TEXT, "contract_key": _INT, "payment_key": _INT, "internet_key": _INT,
                          "tenure": _INT, "tenure_band": _TEXT, "phone_service": _INT, "multiple_lines": _TEXT,
                          "paperless_billing": _INT, "n_addons": _INT, "n_services": _INT,
                          "monthly_charges": "decimal(18,2)", "total_charges": "decimal(18,2)",
                          "charge_drift": _REAL, "churn": _INT},
    "dim_customer": {"customer_id": _TEXT, "gender": _TEXT, "senior_citizen": _INT, "partner": _INT,
                     "dependents": _INT, "family": _INT},
    "dim_contract": {"contract_key": _INT, "contract_type": _TEXT, "contract_months": _INT},
    "dim_payment": {"payment_key": _INT, "payment_method": _TEXT, "auto_pay": _INT},
    "dim_internet": {"internet_key": _INT, "internet_service": _TEXT},
    "dim_tenure_band": {"tenure_band": _TEXT, "band_order": _INT},
    "dim_segment": {"customer_id": _TEXT, "segment_id": _INT, "segment_name": _TEXT},
    "bridge_customer_service": {"customer_id": _TEXT, "service_name": _TEXT, "status": _TEXT},
    "fact_churn_score": {"customer_id": _TEXT, "model_name": _TEXT, "churn_probability": _REAL,
                         "risk_tier": _TEXT, "scored_at": "timestamp", "split": _TEXT, "targeted": _INT},
}


def _added(name: str) -> dict:
    """Columns the BI layer derives on reading."""
    return {
        "fact_subscription": {"status": lambda: X.status(F.col("churn"))},
        "dim_customer": {"age_group": lambda: X.age_group(F.col("senior_citizen")),
                         "household": lambda: X.household(F.col("partner"), F.col("dependents"))},
        "dim_payment": {"payment_short": lambda: X.payment_short(F.col("payment_method"))},
        "bridge_customer_service": {"service": lambda: X.service_label(F.col("service_name"))},
        "fact_churn_score": {"tier_order": lambda: X.tier_order(F.col("risk_tier")),
                             "probability_bucket": lambda: X.probability_bucket(F.col("churn_probability"))},
    }.get(name, {})


def read_bi_extract(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Header, all text trimmed, then typed per table, then the derived columns."""
    types = BI_TYPES[name]
    text = read_raw_subscriptions(spark, f"{folder}/{name}", list(types))
    typed = X.trim_strings(text).select([F.col(c).try_cast(t).alias(c) for c, t in types.items()])
    return typed.withColumns({c: build() for c, build in _added(name).items()})


