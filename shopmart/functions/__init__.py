"""Column-expression helpers (money, text, dates); all built-in, codegen-friendly."""

from shopmart.functions import dates, money, text  # noqa: F401
