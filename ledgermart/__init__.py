"""Credit-risk tables, scoring and monitoring as plain DataFrame-to-DataFrame functions on Spark.

Packages
--------
functions   column expressions and distributed statistics shared by the operators
sources     raw schemas, partitioned stores, and views over the sample tables
operators   one module per subject: ledger, silver, features, profile, monitoring, ...
plans       end-to-end flows (medallion backfill, training, scoring, monitoring)
registry    the checked queries and their SQL counterparts
"""
