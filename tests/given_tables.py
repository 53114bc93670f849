"""Where the given tables are."""

TESTDATA = "/root/testdata/sf0.001"
