"""Transforms and named queries. Every function takes DataFrames and
returns a DataFrame; none writes or loops over rows on the driver. The only
value fetched to the driver is the one-date anchor of the cost windows when
none is given (``cost._as_of``)."""
