"""Training-data operators: search, tokens, mixing, de-duplication, archives and filters.

Nothing outside this package imports it. Each module holds one operator with a
general interface; :mod:`tripflow.llm.queries` applies them to the shared tables.
"""
