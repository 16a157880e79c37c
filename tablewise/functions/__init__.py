"""Column-expression helpers built only from `pyspark.sql.functions`."""
