"""Sources and sinks: derived driver tables, JSON/VARIANT records, the partitioned store."""
