from emberwake.functions.scalars import (
    FULL_MASK, GREETINGS, KEY_UP, classify, dispatch, draw_hash, is_sentinel, item_key, key_code_dimension,
    key_code_rows, key_label, key_override, mask_match, mask_union, mask_without, modifiers,
    norm, pick, second_key, type_bit,
)

__all__ = [
    "FULL_MASK", "GREETINGS", "KEY_UP", "classify", "dispatch", "draw_hash", "is_sentinel", "item_key",
    "key_code_dimension", "key_code_rows", "key_label", "key_override", "mask_match",
    "mask_union", "mask_without", "modifiers", "norm", "pick", "second_key", "type_bit",
]
