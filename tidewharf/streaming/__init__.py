"""Nothing here yet on purpose: every input of this library is a batch table.

The operators are stateless functions of DataFrames, so a caller who receives tables as streams can
apply the cleaning and rule functions inside ``foreachBatch``.
"""
