"""The checks as DuckDB SQL over the test tables, to compare the Spark results with."""
