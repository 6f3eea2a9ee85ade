"""Market-shaped views of the given tables and the registered queries over them."""
