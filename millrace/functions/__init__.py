from millrace.functions.columns import columns_of, equal, matches, name, quoted
from millrace.functions.messages import decode_message
from millrace.functions.text import token_count, token_frequency, tokens

__all__ = [
    "columns_of",
    "decode_message",
    "equal",
    "matches",
    "name",
    "quoted",
    "token_count",
    "token_frequency",
    "tokens",
]
