"""acopio: record linkage, list consolidation and data quality on Spark SQL."""
