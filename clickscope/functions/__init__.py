"""Column expressions (scalar functions, predicates, bucket labels)."""

from clickscope.functions.exprs import *  # noqa: F401,F403
