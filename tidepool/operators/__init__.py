"""Table operators: ``f(DataFrame, ...) -> DataFrame``."""
