"""strata: a layered JSON-to-mart engine on PySpark.

Raw API responses land keyed and untouched (collect layer), are typed
(conform layer) and joined into consumption tables (consume layer).  Every
step is a DataFrame function; the runner in ``strata.plans.jobs`` only reads
and writes tables.
"""

__all__ = ["session", "schemas"]
