"""Column functions: text parsing, ids, nutrition scoring."""

from menulake.functions.ids import stable_id  # noqa: F401
from menulake.functions.text import (  # noqa: F401
    amount_or_zero, check_url, parse_amount, parse_unit, resolve_url, snake_case, strip_ws,
)
from menulake.functions.nutrition import (  # noqa: F401
    enrich_serving_rows, enrich_servings, golden_ratio, macro_shares, number_or_text, profile_tags, ratio_class,
    serving_struct, typed_nutrition, with_item_defaults,
)
