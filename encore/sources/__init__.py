"""Inputs: schemas, partition scans, the client-log reader and decoder (J1),
the JDBC snapshot import (J0), and ``driver_tables`` -- the raw tables of
the business derived from the test environment's tables."""
