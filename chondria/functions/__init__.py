"""Pure column expressions: no I/O, no session, no UDF."""
