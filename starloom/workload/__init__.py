"""The queries the library is checked with: each runs on the sample tables, most with a SQL twin."""
