"""The named queries: each operator bound to the tables of a folder, and its SQL twin."""
