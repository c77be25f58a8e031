"""Claims analytics on Spark: bronze ingestion, silver cleaning, gold scoring.

Typical use::

    from claimwright.session import get_session
    from claimwright.plans import silver, gold

    claims = silver.claims_processed(batch_bronze, stream_bronze, as_of="2000-06-01")
    members = silver.members_processed(members_bronze, as_of="2000-06-01")
    providers = silver.providers_processed(providers_bronze)
    dims = gold.store_dimensions(claims, members, providers)
    analytics = gold.claims_analytics(claims, dims)
    monthly = gold.monthly_claims_summary(analytics)

or build and store every dataset in order with
:func:`claimwright.plans.medallion.materialize`.
"""

__version__ = "0.1.0"
