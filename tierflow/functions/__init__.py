"""Column-level building blocks (all JVM-side Spark expressions)."""
