"""News-feed and transcript jobs as plain Spark DataFrame code.

Everything is a function from DataFrame (or Column) to DataFrame (or Column);
clocks, zones, host lists and prompts are always arguments.
"""
