"""End-to-end compositions (X1, and the ML chain).

``process_events``: trust lookup -> risk -> incident -> response request, for a
batch of events (the batch form of handling one event at a time).
``end_to_end``: packets -> window features -> forest predictions and rule
detections -> findings per (window, device) -> ``process_events``.
Everything is one lazy plan except the small fitted parameters (grid anchor,
scaler, forest nodes), which come back to the driver once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import assess
from ..operators import features as W
from ..operators import forest as M
from ..operators import prep as P
from ..operators import rules as R
from ..operators.findings import as_maps, event_key, findings_from_detections
from ..operators.incidents import build_incidents
from ..operators.responses import create_requests
from ..operators.trust import trusted_flag
from ..session import materialize


def process_events(events: DataFrame, trust_store: DataFrame, created_at: str,
                   start_number: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """X1 on events ``(event_key, device_mac, device_ip, flags, confidence,
    anomaly_score, is_anomaly)`` -> (assessed, incidents, requests).  A
    ``trusted`` column already on the events is used as is."""
    ev = events if "trusted" in events.columns else trusted_flag(events, trust_store)
    ev = ev.withColumn("risk", assess(F.col("flags"), F.col("confidence"), F.col("anomaly_score"),
                                      F.col("is_anomaly"), F.col("trusted")))
    # incidents and requests both read the assessed events: computed once
    ev = materialize(ev)
    incidents = build_incidents(ev, created_at, ["event_key"])
    requests = create_requests(incidents, created_at, start_number)
    return ev, incidents, requests


def ml_chain(packets: DataFrame, window_seconds: float = 30, bounds: tuple | None = None, **forest_kw):
    """Features -> impute -> scale -> fit -> predict (unscaled input + scaler)."""
    # one row per window, read by every fitting step: computed once
    feats = materialize(W.engineer_features(packets, window_seconds, include_bin=True, bounds=bounds))
    feats = P.median_impute(feats)
    params = P.scaler_params(P.fit_scaler(feats))
    scaled = P.transform_scaler(feats, params)
    model = M.fit_isolation_forest(scaled, **forest_kw)
    preds = M.predict(model, feats, scaler=params)
    return feats, params, model, preds


def end_to_end(packets: DataFrame, trust_store: DataFrame, created_at: str, window_seconds: float = 30,
               semantics: str = "documented", gateways=None, **forest_kw):
    """X1 from packets: returns (assessed, incidents, requests)."""
    bounds = W.time_bounds(packets)
    feats, _, _, preds = ml_chain(packets, window_seconds, bounds, **forest_kw)
    preds = materialize(preds)
    contested = R.contested_packets(packets)    # read by the IP rules and the conflicts of a window
    dets = R.run_rules(packets, gateways=gateways, semantics=semantics, contested=contested)
    f = findings_from_detections(dets, contested, bounds[0], feats, window_seconds)
    f = f.join(preds.select("bin", "anomaly_score", "is_anomaly"), "bin", "left")
    f = trusted_flag(f, trust_store)
    f = as_maps(f, {"unknown_device": ~F.col("trusted")})
    f = f.withColumn("event_key", event_key())
    return process_events(f, trust_store, created_at)
