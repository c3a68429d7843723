"""Where the driver's tables lie; imported by tests instead of a conftest module."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
