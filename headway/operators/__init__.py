"""Table operators: joins, grouping, ranking, reshaping, spatial joins, checks."""
