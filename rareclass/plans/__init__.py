"""Test views, registered queries and the experiment protocol."""


def registered_queries():
    """(name -> Spark function, name -> SQL)."""
    from rareclass.plans import catalog, queries_data, queries_metrics, queries_models, queries_profile  # noqa: F401

    return catalog.QUERIES, catalog.ORACLES
