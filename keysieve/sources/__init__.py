"""Sources and sinks: word lists, breach range files, CSV/Parquet, test tables."""
