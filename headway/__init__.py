"""Transit warehouse on Spark: raw events to staging, dimensions, facts and marts."""
