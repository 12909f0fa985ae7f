"""The library's queries run on a generic star schema: mapping, queries and the SQL they are checked by."""
