"""Column helpers, built from Spark functions."""

from .casts import divide, fits, stamped, to_int
from .text import mask_social, transaction_key

__all__ = ["divide", "fits", "mask_social", "stamped", "to_int", "transaction_key"]
