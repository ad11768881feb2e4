"""The supplied tables cast as the 18 delivered sources, and the queries registered on them."""
