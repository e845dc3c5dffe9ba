"""Registered jobs (``driver``), their SQL oracles (``oracle``) and the
case-study plans that run on data shaped like the original cases."""

from casework.plans.driver import QUERIES  # noqa: F401
from casework.plans.oracle import SQL  # noqa: F401
