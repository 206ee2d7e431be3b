"""The checked queries and the SQL each must agree with."""
