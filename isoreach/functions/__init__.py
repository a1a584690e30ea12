"""Column functions: hexagon grid, WKT geometry, names and rates."""
