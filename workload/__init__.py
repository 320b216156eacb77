"""The registered queries: the library applied to the given tables, with SQL that gives the same."""
