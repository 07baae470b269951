"""Column-level helpers; all JVM expressions except the base58 and binary readers."""
