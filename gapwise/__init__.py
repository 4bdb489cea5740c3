"""gapwise: activity events to sessions, day partitions and weekly figures, on Spark."""
