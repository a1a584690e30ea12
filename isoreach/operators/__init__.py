"""DataFrame operators: polyfill, spatial joins, coverage, site selection, equity, map layers."""
