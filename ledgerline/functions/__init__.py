"""Column expressions (JVM-side, codegen-friendly) used across the operators."""

from ledgerline.functions.scalars import *  # noqa: F401,F403
