"""Column expressions shared by the feature plans (all JVM-side, no UDF)."""
