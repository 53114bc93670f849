"""Raw lead tables made from the given tables, for tests, the benchmark and the registered queries."""
