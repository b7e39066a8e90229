"""Readers and writers: WET archives (``wet``: Python Data Source and manifest-driven reader;
``wet_text``: JVM-only reader; ``warc``: per-task record framing), control files and outputs
(``files``), sinks (``sinks``), and the planted test relations and archives."""
