"""Model runs, stand-in data sets and the registered queries."""
