"""Training-data operators: each module is one operator, ``queries`` registers them.

Nothing outside this subpackage imports it (``__spark_entry__`` adds its
queries only when the folder is there).
"""
