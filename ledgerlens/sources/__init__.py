"""Sources and sinks: raw CSV logs (``raw``), stage tables and text sinks
(``tables``), and the adapter for the benchmark tables (``testdata``)."""
