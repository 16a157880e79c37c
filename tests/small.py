"""The folder of the smallest tables, for tests that read real ones."""

SF_SMALL = "/root/testdata/sf0.001"
