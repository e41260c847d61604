"""Column functions and vectorised string scorers."""
