"""Column-level helpers: key normalisation, blank handling, amount shares."""

from acctrecon.functions.columns import (
    any_null,
    blank_to_null,
    name_key,
    non_blank,
    nonzero_activity,
    share,
    to_amount,
    valid_merchant_id,
)

__all__ = [
    "any_null", "blank_to_null", "name_key", "non_blank", "nonzero_activity",
    "share", "to_amount", "valid_merchant_id",
]
