"""salesmart: a retail sales mart built on Spark DataFrames.

``functions``  column expressions
``sources``    schemas, readers, writers, staged tables
``operators``  reusable DataFrame operators (joins, quality rules, star build, OLAP, ...)
``plans``      the named queries over the shared test tables, each with its SQL twin
``streaming``  micro-batch order intake
"""
