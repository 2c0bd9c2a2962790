"""Training-data operators.

Each module holds one operator that works on any DataFrame with an identifier
and a text column; ``queries`` applies them to the tables of a data folder.
Nothing outside this subpackage imports it.
"""
