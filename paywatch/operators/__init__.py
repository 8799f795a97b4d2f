from paywatch.operators.daily import dense_domain, fill_days
from paywatch.operators.deviation import add_zscore
from paywatch.operators.first_seen import add_first_seen
from paywatch.operators.heavy import HeavyRule, heavy_keys, split_heavy
from paywatch.operators.histogram import histogram
from paywatch.operators.running import running
from paywatch.operators.trailing import Trailing, add_trailing
from paywatch.operators.usual import add_usual_mismatch

__all__ = [
    "HeavyRule",
    "Trailing",
    "add_first_seen",
    "add_trailing",
    "add_usual_mismatch",
    "add_zscore",
    "dense_domain",
    "fill_days",
    "heavy_keys",
    "histogram",
    "running",
    "split_heavy",
]
