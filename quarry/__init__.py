"""quarry: text-corpus analytics as Spark DataFrame operators.

Every public operator takes and returns DataFrames and is lazy; nothing is
collected to the driver except sizes and model state whose bound is stated
in the operator's docstring.
"""

__version__ = "0.1.0"
