"""The dataset mapping, the query registry and the SQL the queries are checked against."""
