"""Training-data operators: independent operators and their queries.

Nothing else in the library imports this subpackage. ``registry`` holds the
queries over the test tables; each operator module has its own general
interface and states what it does with nulls, empty inputs, ties and repeated
rows.
"""
