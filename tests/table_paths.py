"""Paths of the driver tables that the tests read."""

SF001 = "/root/testdata/sf0.001"
