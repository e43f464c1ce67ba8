"""The given tables read as retail feeds, and the queries checked over them."""
