"""Sources and sinks: CSV scans, separator choice, file-name dates, sinks
with versioned paths, catalog profile, the run ledger and text reports."""
