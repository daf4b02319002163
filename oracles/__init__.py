"""Expected results as DuckDB SQL over the supplied tables, written independently of the Spark plans."""
