"""Sources and sinks: the landed lake zones and the test-table fixture mapping."""
