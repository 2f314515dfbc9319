"""The driver's tables in the roles of the catalogue, and the queries over them."""
