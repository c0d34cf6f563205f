"""Numbers and templates as text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int, plus: bool = False) -> Column:
    """Text with ``digits`` decimals, rounded by the exact binary value (``format_string`` rounds the
    shortest decimal form instead, which moves ties, and ``format_number`` drops small numbers above a tie)."""
    pattern = "0." + "0" * digits if digits else "0"
    x = x.cast("double")
    text = F.call_function("format_number", x, F.lit(f"+{pattern};-{pattern}" if plus else pattern))
    part = F.abs(x) * F.lit(10.0**digits) % F.lit(1.0)
    return F.when(F.abs(part - F.lit(0.5)) < 1e-6, _rounded_exactly(x, digits, plus)).otherwise(text)


def _rounded_exactly(x: Column, digits: int, plus: bool) -> Column:
    """``fixed`` next to a tie: what scaling loses is found by Dekker's product, and equal halves go to the even number."""
    scale = F.lit(10**digits)

    def nearest(size: Column) -> Column:
        scaled, split = size * scale, size * F.lit(134217729.0)
        part, high = scaled % F.lit(1.0), split - (split - size)
        # The scale is a short number, so these two products are exact.
        lost = (high * scale - scaled) + (size - high) * scale
        whole = (scaled - part).cast("bigint")
        return whole + ((part > 0.5) | ((part == 0.5) & ((lost > 0) | ((lost == 0) & (whole % 2 == 1))))).cast("bigint")

    def text(n: Column) -> Column:
        decimals = [F.lit("."), F.lpad((n % scale).cast("string"), digits, "0")] if digits else []
        return F.concat(((n - n % scale) / scale).cast("bigint").cast("string"), *decimals)

    # Lambdas bind a value once, however often it is used.
    made = F.transform(F.transform(F.array(F.abs(x)), nearest), text)
    return F.concat(F.when(x < 0, "-").otherwise("+" if plus else ""), F.element_at(made, 1))


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{name}`` replaced by that column."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if i % 2 or part])
