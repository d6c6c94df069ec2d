"""Keyed-table replication and change data as Spark DataFrame operators."""
