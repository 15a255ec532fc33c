"""Reading and writing a shard-partitioned log."""
