"""Column builders: Column in, Column out, no UDFs."""
