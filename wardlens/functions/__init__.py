from wardlens.functions.dates import between_dates, days_before, parse_date, stay_days  # noqa: F401
from wardlens.functions.numeric import (  # noqa: F401
    exact_round, half_up_units, money_avg, money_avg_rounded, pct, safe_number, safe_ratio,
    strict_number, strict_ratio,
)
from wardlens.functions.text import (  # noqa: F401
    anchor_tokens, first_token, initcap_name, letters_only, strip_trailing, title_case, token_signature,
)
