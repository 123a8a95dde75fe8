"""Sources and sinks: files, JDBC, layer tables, watermarks."""
