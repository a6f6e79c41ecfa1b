"""Column-to-column functions; all are built from JVM-side Spark expressions."""
