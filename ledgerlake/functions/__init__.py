"""Column-expression builders. Each returns a ``Column``; nothing here runs Python per row."""

from ledgerlake.functions.cleaning import (  # noqa: F401
    lower_trim, to_amount, to_ts, upper_trim,
)
from ledgerlake.functions.risk import (  # noqa: F401
    fraud_reasons, is_flagged_score, recommended_action, risk_priority, risk_tier,
    round_score,
)
