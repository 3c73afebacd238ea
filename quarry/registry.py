"""All registered queries and their oracle SQL, merged from the catalog modules."""

from __future__ import annotations


def all_queries() -> dict:
    from quarry import (catalog, catalog_bins, catalog_closed, catalog_clusters, catalog_details, catalog_forecast,
                        catalog_mixture, catalog_models, catalog_more, catalog_nmf, catalog_ops, catalog_partitioned,
                        catalog_selection, catalog_stream, catalog_svm, catalog_text)
    out = {}
    for mod in (catalog, catalog_ops, catalog_text, catalog_models, catalog_more, catalog_stream, catalog_closed,
                catalog_selection, catalog_partitioned, catalog_mixture, catalog_bins, catalog_svm, catalog_clusters,
                catalog_forecast, catalog_details, catalog_nmf):
        out.update(mod.QUERIES)
    return out


def all_oracle_sql() -> dict:
    from quarry import (oracle, oracle_bins, oracle_closed, oracle_clusters, oracle_details, oracle_forecast, oracle_mixture,
                        oracle_models, oracle_more, oracle_ops, oracle_partitioned, oracle_selection, oracle_stream, oracle_svm, oracle_text)
    out = {}
    for mod in (oracle, oracle_ops, oracle_text, oracle_models, oracle_more, oracle_stream, oracle_closed,
                oracle_selection, oracle_partitioned, oracle_mixture, oracle_bins, oracle_svm, oracle_clusters, oracle_forecast,
                oracle_details):
        out.update(mod.oracle_sql())
    return out
