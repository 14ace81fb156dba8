"""Folders of the driver's test tables."""

SF_SMALL = "/root/testdata/sf0.001"
