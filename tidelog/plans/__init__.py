"""Plan shapes shared by the operators: prefix scans, interval joins, scratch tables."""
