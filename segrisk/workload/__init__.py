"""The operators applied to the star-schema test tables, with SQL to check them."""
