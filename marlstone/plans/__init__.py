"""From MySQL-dialect text to Spark SQL: lexer, parser, rendering and partition pruning."""
