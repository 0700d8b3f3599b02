"""All registered queries. Importing the area modules registers them."""

from tenura.plans import catalog
from tenura.plans import breakdowns_q, contract_q, evaluate_q, features_q, models_q, sources_q  # noqa: F401


def queries():
    return catalog.all_queries()


def oracles():
    return catalog.all_oracles()
