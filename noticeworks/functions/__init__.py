"""Column expressions. Everything here is built from pyspark.sql.functions and stays in the JVM."""
