"""Where the test tables are."""

SMOKE = "/root/testdata/sf0.001"
