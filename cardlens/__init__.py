"""cardlens — card-transaction behaviour analytics on Spark.

Reads transaction and merchant tables, cleans them under explicit schema
contracts, joins the merchant dimension and aggregates any volume of
transactions into one row of behaviour features per card. On top of those
features it splits, trains, scores and ranks cards with Spark ML and computes
classification metrics, feature importance and run summaries as DataFrames.

Every stage is a ``DataFrame -> DataFrame`` function meant to be chained with
``df.transform(...)``; nothing passes rows through the driver.
"""

__all__ = ["config", "session"]
