"""The given test tables seen as an order business, and the queries registered over them."""
