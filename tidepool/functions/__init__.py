"""Column functions: ``f(Column, ...) -> Column``, all JVM-side built-ins."""
