"""End-to-end compositions of the operators (the studies the library serves)."""
