"""Tables derived from the test data, and the queries run over them."""
