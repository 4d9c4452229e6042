"""Table sources and result sinks."""
