"""Where the smallest driver tables are."""

SMOKE_DIR = "/root/testdata/sf0.001"
