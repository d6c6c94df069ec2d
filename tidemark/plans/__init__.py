"""Reports over the replication tables."""
