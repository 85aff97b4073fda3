"""Sources and sinks: topics, change feeds, partitioned tables, driver-table views."""
