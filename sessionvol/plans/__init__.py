"""Plan building blocks shared by the operators: joins, ordered blocks, middle values, layers."""
