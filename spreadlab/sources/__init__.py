"""Sources and sinks: table reads, bar normalisation, surrogate bars, JSON inputs, upserts."""
