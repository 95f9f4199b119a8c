"""Writers: partitioned tables, cached results, compaction, file audit."""
