"""txpulse: per-user transaction-stream analytics on PySpark.

Two computations, each in a batch form (window frames, Catalyst end to end)
and a Structured Streaming form (keyed state):

* anomaly alerts: a Credit at least ``factor`` times the user's trailing mean;
* RFM segments: trailing-24h frequency / deposits, tenure, recency, a label.

The batch form is the specification of the streaming form; tests hold the two
equal to each other and to SQL oracles.
"""

from txpulse.operators.anomaly import anomaly_alerts, rolling_avg_check
from txpulse.operators.rfm import RfmRules, rfm_latest, rfm_segments
from txpulse.sources.ingest import parse_transactions, parse_typed_transactions

__all__ = [
    "RfmRules",
    "anomaly_alerts",
    "parse_transactions",
    "parse_typed_transactions",
    "rfm_latest",
    "rfm_segments",
    "rolling_avg_check",
]
