"""Column expressions: all built-in functions, all inside whole-stage codegen where Spark allows."""
