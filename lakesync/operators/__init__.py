"""DataFrame operators: merge, shape, schema, checks, layout."""
