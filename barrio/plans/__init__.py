"""Query catalog over the driver's test tables (see ``catalog``)."""
