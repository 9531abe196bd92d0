"""DuckDB SQL that computes the same results as the Spark queries, written independently of them."""
