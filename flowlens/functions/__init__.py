"""Column-expression helpers: everything here returns a ``Column`` and stays inside codegen."""

from flowlens.functions.columns import *  # noqa: F401,F403
