"""Column-level helpers; all of them stay inside Catalyst expressions."""
