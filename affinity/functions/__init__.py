"""Column-expression helpers shared by the operators (JVM-side, no UDFs)."""
