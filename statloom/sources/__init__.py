"""Reading tables, drawing seeded columns, grids, and stored models."""
