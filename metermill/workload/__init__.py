"""Meter documents derived from the test tables, and the queries registered over them."""
