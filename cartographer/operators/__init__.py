"""DataFrame operators, one module per family of the analytics programme."""
