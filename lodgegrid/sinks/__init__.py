"""Writers: month-partitioned raw table, materialised results, versioned tables."""
