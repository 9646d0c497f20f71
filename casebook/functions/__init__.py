"""Column-expression library (Catalyst expressions only)."""
from casebook.functions.exprs import *  # noqa: F401,F403
