from contrail.functions.scalars import (  # noqa: F401
    delay_minutes,
    delayed_15,
    fields_after_trailing_cut,
    is_cancelled,
    named_value,
    pair_text,
    present,
    round_half_up,
    short_number,
    unquote,
)
