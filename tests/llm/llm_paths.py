"""Where the small test tables of these tests are."""

SMALL = "/root/testdata/sf0.001"
