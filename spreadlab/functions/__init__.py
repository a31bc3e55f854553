"""Column-expression helpers (all JVM-side)."""
from .mathfn import (safe_log, norm_cdf, eg_pvalue, eg_tau_threshold, sigmoid, linear_score,
                     score_signal, proba_signal, guarded_z)
from .text import canonical_symbol, pair_label, split_pair, canonical_timeframe, lower_columns, require_columns
from .timefn import epoch_to_timestamp, epoch_unit, parse_timestamp_string, floor_time, floor_to_5m, ntz_columns
