"""DataFrame to DataFrame operators; clocks and seeds are always parameters."""
