"""Column-in, Column-out builders.  Everything here is a built-in Spark
expression, so it stays inside whole-stage code generation."""
