"""Column -> Column expressions."""

from .dates import parse_date, rfc822_date, sweep_label, sweep_type_of, ts_text  # noqa: F401
from .ids import canonical_url, item_id  # noqa: F401
from .keywords import (any_keyword, blocked_site, contains_any_raw, matched_keywords,  # noqa: F401
                       java_pattern, noise_match, noise_regexes, usable_patterns)
from .numbers import (avg_even, bar_fill, feed_status, noise_pct, rate_pct,  # noqa: F401
                      ratio_pct_even, signal_band)
from .text import (blank_to_empty, collapse_ws, is_blank, points_text, strip_html,  # noqa: F401
                   truncate, url_or_discussion, ustrip, xml_escape)
