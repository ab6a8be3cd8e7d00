"""Catalog, lineage and creation order for tables of SQL scripts, on Spark DataFrames."""
