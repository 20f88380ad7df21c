"""dayguard: account-takeover analytics on customer activity, written for Spark.

Order lines, web sessions and page hits become one row of 36 features per
(customer, day); labelled fraud days are attached; training data is prepared;
three unsupervised anomaly models are trained and scored as Spark jobs; scores
are evaluated with ROC / PR / F1 curves and per-period confusion counts.
"""

from dayguard.params import Params
from dayguard.schema import FEATURES, KEY_COLS

__all__ = ["Params", "FEATURES", "KEY_COLS"]
