"""Match-data engine on PySpark: sources, column functions, operators, streams and plans."""
