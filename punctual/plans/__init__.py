"""Jobs that combine operators: training, bake-offs, the format comparison and the query catalogue."""
