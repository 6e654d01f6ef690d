"""Column-level functions (JVM-side expressions, no Python UDFs)."""

from reelmart.functions.columns import (bayes_rating, blank_to_null, greatest_strict, has_both,
                                        ieq, least_strict, margin, mask_unless, md5_bucket,
                                        profit, safe_ratio, tier, zero_to_null)
from reelmart.functions.payload import FieldSpec, extract, get_field

__all__ = ["bayes_rating", "blank_to_null", "greatest_strict", "has_both", "ieq", "least_strict",
           "margin", "mask_unless", "md5_bucket", "profit", "safe_ratio", "tier",
           "zero_to_null", "FieldSpec", "extract", "get_field"]
