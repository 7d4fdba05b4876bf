"""Training-data operators: each module holds one operator and its general interface.

Nothing outside this package imports it.  ``queries`` wires the operators to the
test tables, one ``opN_<name>`` query each.
"""
