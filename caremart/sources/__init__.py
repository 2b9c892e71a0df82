"""Sources and sinks: delimited files, document files, manifests, tables."""
