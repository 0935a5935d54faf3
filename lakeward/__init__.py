"""lakeward: medallion warehouse operators expressed as Spark DataFrame plans.

Sub-packages
------------
functions   Column builders (cleansing, keys, dates, JSON, predicates).
operators   DataFrame -> DataFrame verbs (dedup, joins, generators, allocation, marts).
sources     landing, scanning, ledger and load verbs (bronze/staging layers).
quality     declarative data-quality rules, gate and reconciliation.
streaming   micro-batch loading of landed files with Structured Streaming.
plans       the registered demonstration queries over the driver tables.
"""

__version__ = "0.1.0"
