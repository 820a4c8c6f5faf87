"""Column expressions: hashed random numbers, activations, polynomial terms."""
