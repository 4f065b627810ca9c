"""quarry: user-level analytics operators expressed as Spark DataFrame plans.

Every public function takes DataFrames (or Columns) and returns a lazy
DataFrame (or Column).  Nothing is collected to the driver except small,
size-checked parameters (bounded query lists, d x d matrices).
"""

__version__ = "0.1.0"
