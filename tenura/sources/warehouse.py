"""Staged tables: built once per application, read by every question.

The expensive step is deriving the extract from the order tables (three shuffles of line items).
It runs once and is written as parquet to the shared folder, so a lost executor costs a re-read,
not a re-derivation, and the questions read only their columns. Sizes of the small tables are known
from their files, which lets Catalyst decide on broadcasts itself.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.operators import scoring, split, star
from tenura.session import shared_folder
from tenura.sources import snapshot

_open: dict[tuple, "Warehouse"] = {}
SOURCES = ("customer", "orders", "lineitem", "part", "events")


def _stamp(spark: SparkSession, data_dir: str) -> tuple:
    """Time and length of the source files, so that replaced files are not answered from old tables."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for name in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{data_dir.rstrip('/')}/{name}.parquet")
        store = path.getFileSystem(conf)
        if store.exists(path):
            status = store.getFileStatus(path)
            found.append((name, status.getModificationTime(), status.getLen()))
    return tuple(found)


class Warehouse:
    """Named tables derived from one folder of parquet tables."""

    def __init__(self, spark: SparkSession, data_dir: str, stamp: tuple = ()):
        self.spark = spark
        self.data_dir = data_dir.rstrip("/")
        app = spark.sparkContext.applicationId
        tag = hashlib.md5(f"{self.data_dir}{stamp}".encode()).hexdigest()[:10]
        self.folder = f"{shared_folder(spark)}/tenura/{app}/{tag}"
        self._staged: dict[str, DataFrame] = {}

    @classmethod
    def open(cls, spark: SparkSession, data_dir: str) -> "Warehouse":
        stamp = _stamp(spark, data_dir)
        at = (spark.sparkContext.applicationId, data_dir, stamp)
        if at not in _open:
            _open[at] = cls(spark, data_dir, stamp)
        return _open[at]

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    def stage(self, name: str, build) -> DataFrame:
        """Write the table on first use and read it back."""
        if name not in self._staged:
            frame = build()
            frame.write.mode("overwrite").parquet(f"{self.folder}/{name}")
            self._staged[name] = self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")
        return self._staged[name]

    # --- staged ---------------------------------------------------------------------------
    def raw(self) -> DataFrame:
        return self.stage("raw", lambda: snapshot.subscriptions(
            self.source("customer"), self.source("orders"), self.source("lineitem"),
            self.source("part")))

    def peer_prices(self) -> DataFrame:
        return self.stage("peer_prices", lambda: star.peer_prices(self._labelled()))

    def tenure_ranks(self) -> DataFrame:
        return self.stage("tenure_ranks", lambda: star.tenure_ranks(self._labelled()))

    def mart(self) -> DataFrame:
        """Features of every customer plus the two features relative to the base. No shuffle: a scan
        of the extract joined with two small tables."""
        def build():
            wide = star.price_vs_peers(self._labelled(), self.peer_prices())
            return X.log_total_charges(star.tenure_pct_in_contract(wide, self.tenure_ranks()))
        return self.stage("mart", build)

    def mart_view(self) -> DataFrame:
        """The mart as the joined view over the star, not the staged copy."""
        star_tables = self.star()
        view = star.customer_360(self.fact(), star_tables["dim_customer"], *(self.dim(d) for d in (
            "dim_contract", "dim_payment", "dim_internet")))
        return star.feature_mart(view, star.pivot_addons(star_tables["bridge_customer_service"]), self.peer_prices(), self.tenure_ranks())

    def split_cuts(self) -> DataFrame:
        return self.stage("split_cuts", lambda: split.split_cuts(
            self.mart(), "customer_id", "churn", D.SplitSizes()))

    def scored(self) -> DataFrame:
        """One row per customer and scorecard: outcome, probability, charge, split."""
        def build():
            assigned = split.assign_split(self.mart(), "customer_id", "churn",
                                          self.split_cuts(), D.SplitSizes())
            return scoring.scorecards(assigned)
        return self.stage("scored", build)

    # --- derived on the fly ------------------------------------------------------------------
    def features(self) -> DataFrame:
        return X.build_features(self.raw())

    def _labelled(self) -> DataFrame:
        return self.features().withColumnRenamed("contract", "contract_type")

    def dim(self, name: str) -> DataFrame:
        build = {"dim_contract": star.dim_contract, "dim_payment": star.dim_payment,
                 "dim_internet": star.dim_internet}[name]
        return self.stage(name, lambda: build(self.features()))

    def fact(self) -> DataFrame:
        return self.stage("fact_subscription", lambda: star.fact_subscription(
            self.features(), self.dim("dim_contract"), self.dim("dim_payment"), self.dim("dim_internet")))

    def star(self) -> dict[str, DataFrame]:
        return {
            "dim_contract": self.dim("dim_contract"), "dim_payment": self.dim("dim_payment"),
            "dim_internet": self.dim("dim_internet"),
            "dim_tenure_band": star.dim_tenure_band(self.spark),
            "dim_customer": star.dim_customer(self.features()),
            "fact_subscription": self.fact(),
            "bridge_customer_service": star.unpivot_addons(self.features()),
        }

    def customer_360(self) -> DataFrame:
        """The 360 columns, served from the staged mart (same rows as the star join)."""
        return self.mart().select(
            "customer_id", "gender", "senior_citizen", "partner", "dependents", "family",
            "contract_type", "contract_months", "payment_method", "auto_pay", "internet_service",
            "tenure", "tenure_band", "phone_service", "multiple_lines", "paperless_billing",
            "n_addons", "n_services", "monthly_charges", "total_charges", "charge_drift", "churn")

    def model_scores(self) -> DataFrame:
        return self.scored().select("customer_id", "model_name", "churn_probability", "risk_tier",
                                    "scored_at")

    def best_scores(self, model: str = "scorecard") -> DataFrame:
        """Score extract of one model, with split and campaign flag."""
        return scoring.score_extract(self.scored(), model)

    def segments(self) -> DataFrame:
        """Rule-based segment label (stands in for a clustering where an exact answer is needed)."""
        return self.mart().withColumn("segment_id", scoring.rule_segment())

    def activity(self) -> DataFrame:
        return snapshot.activity_spans(self.source("events"), quiet_days=0)
