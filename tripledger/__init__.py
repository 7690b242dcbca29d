"""Spark analytics over two tables of ride records: fares and trips."""
