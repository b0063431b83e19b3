"""sitefold: analytics over tables that are split and copied across sites, on Spark.

Sub-packages
------------
functions   column expressions (NULL, date, price and label semantics)
sources     relation schemas, loading, the site catalog and atomic publishing
operators   fragmentation, key numbering, changes, comparison, integrity checks
plans       global views, reports, listings and booking jobs built from the operators
streaming   continuous and on-demand replication
"""
