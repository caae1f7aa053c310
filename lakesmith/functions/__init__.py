from .keys import UNKNOWN_KEY, date_key, iso_date_text, surrogate_key
from .text import blank_to_null, col_, fold_case, guarded_cast

__all__ = [
    "UNKNOWN_KEY",
    "blank_to_null",
    "col_",
    "date_key",
    "fold_case",
    "guarded_cast",
    "iso_date_text",
    "surrogate_key",
]
