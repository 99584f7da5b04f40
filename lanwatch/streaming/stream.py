"""Structured Streaming versions of ingest, window features, rules and risk (V1–V6).

* V1 ``read_packet_stream``: file source with an explicit schema, event time
  ``ts`` and a watermark.
* V2 ``stream_window_features``: two chained ``groupBy(window)`` aggregations
  (append mode).  Windows are epoch-anchored and only non-empty windows are
  emitted (the batch grid is anchored at the first packet and fills gaps).
* V3/V4 ``stream_ip_rules`` / ``stream_mac_rules``: per-key state with
  ``applyInPandasWithState``; keyed by sender IP (rules 1–3) and sender MAC
  (rules 4–5), the keys dealt over a fixed number of groups.  Rows are buffered until the watermark passes them and then
  processed in ``(ts_us, seq)`` order, so on complete input the stream emits
  exactly what the batch rules emit.  Rows older than what a key already
  processed are late and dropped.  State keeps only what the windows need
  (times within the window, counters, the last MAC of an IP) and the rows
  ahead of the watermark (as columns of numbers), never the whole history; MAC-keyed state is evicted once idle, IP-keyed state is
  kept because rule 1 compares with the previous MAC however old.
* V6 ``stream_risk``: detections -> findings -> trust (stream-static join)
  -> risk -> incidents, appended per micro-batch with deterministic ids.
"""

from __future__ import annotations

import json
from collections import Counter, deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import schema as S
from ..functions.risk import assess
from ..operators.findings import FINDING_EVENTS
from ..operators.incidents import INCIDENT_SCHEMA, build_incidents
from ..operators.trust import trusted_flag
from ..session import ship_package

STREAM_DETECTION_SCHEMA = ("rule_no int, seq long, ts_us long, event_type string, severity string, "
                           "device_ip string, device_mac string, measure long")
_STATE_SCHEMA = "state string, buffer binary"


# ------------------------------------------------------------------ V1

def read_packet_stream(spark: SparkSession, path: str, fmt: str = "parquet", watermark: str = "2 minutes",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.PACKET_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    return with_event_time(df, watermark)


def with_event_time(df: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    return df.withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", watermark)


# ------------------------------------------------------------------ V2

def stream_window_features(packets: DataFrame, window_seconds: int = 30) -> DataFrame:
    """Chained window aggregates: one small row per (window, distinct thing), then counts per window.

    A packet states four facts: its MAC, its sender IP, its target IP and its (IP, MAC) pair were seen.  The first
    aggregate keeps one row a fact, whose state is a few numbers; the second counts the rows by kind.
    """
    length = f"{window_seconds} seconds"
    fact = lambda kind, a, b=None: F.struct(
        F.lit(kind).alias("kind"), F.col(a).alias("a"), (F.col(b) if b else F.lit(None).cast("string")).alias("b"))
    facts = packets.select("ts", "op", F.explode(F.array(
        fact("mac", "src_mac"), fact("src", "src_ip"), fact("dst", "dst_ip"), fact("pair", "src_mac", "src_ip"))).alias("f"))
    once = facts.groupBy(F.window("ts", length).alias("w"), "f").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("op") == 1).alias("n_req"), F.count_if(F.col("op") == 2).alias("n_rep"),
    ).select(F.window_time("w").alias("wt"), "f", "n", "n_req", "n_rep")
    known = lambda kind, c="f.a": F.count_if((F.col("f.kind") == kind) & F.col(c).isNotNull())
    of_mac = lambda c: F.when(F.col("f.kind") == "mac", F.col(c))
    per_win = once.groupBy(F.window("wt", length).alias("w2")).agg(
        F.sum(of_mac("n")).alias("total"),
        F.sum(of_mac("n_req")).alias("arp_request_count"),
        F.sum(of_mac("n_rep")).alias("arp_reply_count"),
        F.count_if(F.col("f.kind") == "mac").alias("unique_src_macs"),
        known("src").alias("unique_src_ips"),
        known("dst").alias("unique_dst_ips"),
        known("pair", "f.b").alias("ip_mac_pair_count"),
        F.max(of_mac("n")).alias("max_packets_per_mac"),
    )
    req, rep = F.col("arp_request_count"), F.col("arp_reply_count")
    return per_win.select(
        (F.unix_micros(F.col("w2.start")) / F.lit(1e6)).alias("window_start"),
        "arp_request_count", "arp_reply_count",
        F.round(rep / F.greatest(req, F.lit(1)), 6).alias("reply_request_ratio"),
        "unique_src_macs", "unique_src_ips", "unique_dst_ips", "ip_mac_pair_count", "max_packets_per_mac",
        (F.col("ip_mac_pair_count") - F.col("unique_src_macs")).alias("mac_ip_change_count"),
        F.round(F.greatest(rep - req, F.lit(0)) / F.greatest(F.col("total"), F.lit(1)), 6)
        .alias("unsolicited_reply_ratio"),
    )


# ------------------------------------------------------------------ V3 / V4 state machines

def _ip_rows(st: dict, ip, rows, gateways, out: list):
    """Rules 1–3 for packets ``(ts, seq, op, ip, mac)`` of one sender IP, in order; a packet costs the same whatever the windows hold."""
    w1, w2 = S.CHANGE_WINDOW_S * S.US, S.CLAIM_WINDOW_S * S.US
    prev, n_changes = st.get("mac"), st.get("n_chg", 0)
    changes, claims = deque(st.get("chg", [])), deque(st.get("claims", []))
    macs = Counter(m for _, m in claims)
    for ts, seq, _, _, mac in rows:
        while changes and changes[0] <= ts - w1:
            changes.popleft()
        if prev is not None and prev != mac:
            earlier = len(changes)
            rapid = earlier >= S.RAPID_CHANGES
            n_changes += 1
            out.append((1, seq, ts, "ARP_SPOOFING_ATTACK" if rapid else "IP_MAC_MAPPING_CHANGE",
                        "CRITICAL" if rapid else "MEDIUM", ip, mac, earlier if rapid else n_changes))
            changes.append(ts)
            if ip in gateways:
                out.append((3, seq, ts, "GATEWAY_MAPPING_CHANGE", "CRITICAL", ip, mac, n_changes))
        prev = mac
        _forget(claims, macs, ts - w2)
        claims.append((ts, mac))
        macs[mac] += 1
        n = len(macs)
        if n >= S.CLAIMS_HIGH:
            out.append((2, seq, ts, "DUPLICATE_IP_CLAIM", "CRITICAL" if n >= S.CLAIMS_CRITICAL else "HIGH", ip, mac, n))
    st.update(mac=prev, n_chg=n_changes, chg=list(changes), claims=list(claims))


def _mac_rows(st: dict, mac, rows, out: list):
    """Rules 4–5 for packets ``(ts, seq, op, mac, src_ip, dst_ip)`` of one sender MAC, in order."""
    w4, w5 = S.RATE_WINDOW_S * S.US, S.STORM_WINDOW_S * S.US
    times, reqs = deque(st.get("t", [])), deque(st.get("req", []))
    targets = Counter(d for _, d in reqs if d is not None)
    for ts, seq, op, _, src_ip, dst_ip in rows:
        while times and times[0] <= ts - w4:
            times.popleft()
        times.append(ts)
        n = len(times)
        if n > S.RATE_LIMIT:
            flood = n > S.FLOOD_LIMIT
            out.append((4, seq, ts, "MAC_FLOODING" if flood else "UNUSUAL_ARP_ACTIVITY",
                        "CRITICAL" if flood else "HIGH", src_ip, mac, n))
        _forget(reqs, targets, ts - w5)
        if op == S.OP_REQUEST:
            reqs.append((ts, dst_ip))
            if dst_ip is not None:
                targets[dst_ip] += 1
            if len(targets) > S.STORM_TARGETS:
                out.append((5, seq, ts, "ARP_REQUEST_STORM", "HIGH", src_ip, mac, len(targets)))
    st.update(t=list(times), req=list(reqs))


def _forget(window: deque, counts: Counter, edge: int):
    """Take entries ``(time, value)`` up to ``edge`` out of a window and of the counts of its values."""
    while window and window[0][0] <= edge:
        _, value = window.popleft()
        if value in counts:
            counts[value] -= 1
            if not counts[value]:
                del counts[value]


class _Buffer:
    """Waiting packets as columns: numbers, and texts (the key first) as codes into their distinct values."""

    def __init__(self, texts, packed: bytes | None = None):
        self.texts = texts
        self.words: list[dict] = [{} for _ in texts]
        self.parts: list[tuple] = []
        if packed:
            head, data = packed.split(b"\n", 1)
            n, words = json.loads(head)
            self.words = [{w: k for k, w in enumerate(ws)} for ws in words]
            ends = np.cumsum([0, 8 * n, 8 * n, n, *[4 * n for _ in texts]]).tolist()
            kinds = [np.int64, np.int64, np.int8, *[np.int32 for _ in texts]]
            self.parts.append(tuple(np.frombuffer(data[a:b], k) for a, b, k in zip(ends, ends[1:], kinds, strict=False)))

    def add(self, pdf: pd.DataFrame, done: dict):
        """Append the packets later than what their key has ``done``; the others are late, and so are packets without a time."""
        edge = np.fromiter((done.get(k, -1) for k in pdf[self.texts[0]].tolist()), np.int64, len(pdf))
        late = ~(pdf["ts_us"].to_numpy() > edge)
        if late.any():
            pdf = pdf[~late]
        if not len(pdf):
            return
        codes = [np.fromiter((w.setdefault(v, len(w)) for v in pdf[c].tolist()), np.int32, len(pdf))
                 for c, w in zip(self.texts, self.words, strict=True)]
        if pdf["seq"].hasnans:
            raise ValueError("a packet without seq has no place in the order of arrival")
        op = pdf["op"].fillna(0) if pdf["op"].hasnans else pdf["op"]
        self.parts.append((pdf["ts_us"].to_numpy().astype(np.int64), pdf["seq"].to_numpy().astype(np.int64),
                           op.to_numpy().astype(np.int8), *codes))

    def take(self, until: int):
        """Remove the packets up to ``until``; yields for each key its packets ``(ts, seq, op, *texts)`` by time and seq."""
        if not self.parts:
            return
        cols = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        due = cols[0] <= until
        self.parts = [] if due.all() else [tuple(c[~due] for c in cols)]
        at = np.flatnonzero(due)
        at = at[np.lexsort((cols[1][at], cols[0][at], cols[3][at]))]
        key = cols[3][at]
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(at)]
        words = [list(w) for w in self.words]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                own = at[a:b]
                texts = [map(ws.__getitem__, c[own].tolist()) for ws, c in zip(words, cols[3:], strict=True)]
                yield words[0][key[a]], int(cols[0][own[-1]]), zip(*[c[own].tolist() for c in cols[:3]], *texts, strict=True)

    def oldest(self) -> int | None:
        return int(self.parts[0][0].min()) if self.parts else None

    def keys(self) -> set:
        return set(map(list(self.words[0]).__getitem__, np.unique(self.parts[0][3]).tolist())) if self.parts else set()

    def pack(self) -> bytes | None:
        if not self.parts:
            return None
        ts, seq, op, *codes = self.parts[0]
        # only the values still in use
        used = [np.unique(c, return_inverse=True) for c in codes]
        words = [list(w) for w in self.words]
        head = json.dumps([len(ts), [[ws[k] for k in u.tolist()] for ws, (u, _) in zip(words, used, strict=True)]])
        return b"".join([head.encode(), b"\n", ts.tobytes(), seq.tobytes(), op.tobytes(),
                         *[i.astype(np.int32).tobytes() for _, i in used]])


KEY_GROUPS = 256       # part of a checkpoint: a query goes on with the number it began with
IDLE_US = 600 * S.US


def _stateful(step, texts, evict: bool = True):
    """State of a group of keys: ``[key, state, last time]`` of each and their waiting packets.

    ``step(state, key, packets, out)`` takes what the watermark has passed of a key, packets ``(ts, seq, op, *texts)``; the
    first of ``texts`` is the key.
    """
    cols = ["rule_no", "seq", "ts_us", "event_type", "severity", "device_ip", "device_mac", "measure"]

    def fn(_, pdfs, state):
        raw, packed = state.get if state.exists else ("[]", None)
        known = {key: (st, done) for key, st, done in json.loads(raw)}
        done = {key: at for key, (_, at) in known.items()}
        buf = _Buffer(texts, packed)
        for p in pdfs:
            buf.add(p, done)
        wm_ms = state.getCurrentWatermarkMs()
        out: list = []
        for key, last, packets in buf.take(wm_ms * 1000):
            st = known[key][0] if key in known else {}
            step(st, key, packets, out)
            known[key] = (st, last)
        if evict:
            # windowed state only (rules 4-5): nothing to remember once idle
            waits = buf.keys()
            known = {k: v for k, v in known.items() if v[1] > wm_ms * 1000 - IDLE_US or k in waits}
        oldest = buf.oldest()
        if not known and oldest is None:
            state.remove()
        else:
            state.update((json.dumps([[k, st, at] for k, (st, at) in known.items()]), buf.pack()))
            # wake up once the watermark passes the oldest buffered row
            nxt = oldest // 1000 + 1 if oldest is not None else wm_ms + IDLE_US // 1000
            state.setTimeoutTimestamp(max(nxt, wm_ms + 1))
        if out:
            yield pd.DataFrame(out, columns=cols)
    return fn


def _grouped(packets: DataFrame, key: str):
    """Packets by groups of keys: calling Python and storing state cost a group, not a key, and a trigger touches few groups."""
    ship_package(packets.sparkSession)
    group = F.pmod(F.xxhash64(F.col(key)), F.lit(KEY_GROUPS)).cast("int").alias("key_group")
    return packets.select("seq", "ts_us", "op", "src_ip", "src_mac", "dst_ip", "ts", group).groupBy("key_group")


def stream_ip_rules(packets: DataFrame, gateways=None) -> DataFrame:
    """V3: rules 1–3 (documented semantics) keyed by sender IP."""
    gws = set(gateways or S.DEFAULT_GATEWAYS)

    def step(st, ip, rows, out):
        _ip_rows(st, ip, rows, gws, out)

    # rule 1 compares with the IP's previous MAC however old: the per-IP
    # state (last MAC, counters, windowed lists) is kept, never evicted
    return _grouped(packets, "src_ip").applyInPandasWithState(
        _stateful(step, ("src_ip", "src_mac"), evict=False), STREAM_DETECTION_SCHEMA, _STATE_SCHEMA,
        "append", GroupStateTimeout.EventTimeTimeout)


def stream_mac_rules(packets: DataFrame) -> DataFrame:
    """V4: rules 4–5 (documented semantics) keyed by sender MAC."""
    return _grouped(packets, "src_mac").applyInPandasWithState(
        _stateful(_mac_rows, ("src_mac", "src_ip", "dst_ip")), STREAM_DETECTION_SCHEMA, _STATE_SCHEMA,
        "append", GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------------------------ V6

def detection_findings(dets: DataFrame, window_seconds: int = 30) -> DataFrame:
    """Per detection: (epoch-anchored window, device) finding flags."""
    w_us = window_seconds * S.US
    return dets.select(
        (F.col("ts_us") - F.pmod(F.col("ts_us"), F.lit(w_us))).alias("window_us"),
        "device_mac", "device_ip", "event_type",
        *[F.col("event_type").isin(evts).alias(name) for name, evts in FINDING_EVENTS.items()])


def risk_batch(findings: DataFrame, trust_store: DataFrame, created_at: str) -> DataFrame:
    """V6 body: findings (one or more rows per window and device), trust, risk, incidents."""
    f = findings.groupBy("window_us", "device_mac", "device_ip").agg(
        *[F.bool_or(n).alias(n) for n in FINDING_EVENTS])
    f = trusted_flag(f, trust_store)
    names = list(FINDING_EVENTS) + ["unknown_device"]
    flags = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                              F.array(*[F.col(n) for n in FINDING_EVENTS], ~F.col("trusted")))
    f = f.withColumn("risk", assess(flags, F.create_map().cast("map<string,double>"),
                                    F.lit(None).cast("double"), F.lit(False), F.col("trusted")))
    f = f.withColumn("event_key", F.concat_ws("|", F.col("window_us").cast("string"), "device_mac",
                                              F.coalesce("device_ip", F.lit(""))))
    return build_incidents(f, created_at, ["event_key"])


FINDING_SCHEMA = ("window_us long, device_mac string, device_ip string, "
                  + ", ".join(f"{n} boolean" for n in FINDING_EVENTS) + ", stream string, batch long")


def stream_risk(dets: DataFrame, trust_store: DataFrame, incident_path: str, checkpoint: str,
                created_at: str, trigger: dict | None = None, name: str = "rules"):
    """V6: start a query that scores every window and device on all detections seen so far.

    A micro-batch stores its findings, one row per window and device, under ``<incident_path>-findings``, by
    stream and batch, laid out by ranges of the window, so that a file holds a stretch of time and there are no
    more files than tasks.  The windows and devices it touched are then scored again from the
    stored findings of all batches and streams (only files of their time are read), and go to
    ``<incident_path>/stream=<name>/batch=<id>``.  Both writes overwrite the batch's own folder, so a
    retried batch replaces its output.  Spark allows one stateful rule operator in a query, so rules 1-3 and
    rules 4-5 are two queries with different names and one log.  An incident keeps its id; evidence only grows, so
    ``current_incidents`` reads the highest score of each.
    """
    store_path = f"{incident_path}-findings"

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        keys = ["window_us", "device_mac", "device_ip"]
        new = detection_findings(batch).groupBy(*keys).agg(*[F.bool_or(n).alias(n) for n in FINDING_EVENTS])
        own = f"{store_path}/stream={name}/batch={batch_id}"
        new.repartitionByRange("window_us", "device_mac", "device_ip").write.mode("overwrite").parquet(own)
        stored = spark.read.schema(FINDING_SCHEMA).option("basePath", store_path).parquet(store_path)
        here = stored.where((F.col("stream") == name) & (F.col("batch") == batch_id))
        lo, hi = here.agg(F.min("window_us"), F.max("window_us")).first()
        touched = here.select(*[F.col(k).alias(f"_{k}") for k in keys])
        known = stored.where(F.col("window_us").between(lo, hi)) if lo is not None else here
        match = [known[k].eqNullSafe(touched[f"_{k}"]) for k in keys]
        inc = risk_batch(known.join(touched, match, "left_semi"), trust_store, created_at)
        inc.write.mode("overwrite").json(f"{incident_path}/stream={name}/batch={batch_id}")

    w = dets.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def current_incidents(spark: SparkSession, incident_path: str) -> DataFrame:
    """Every incident of the streams that share this log, with all its evidence."""
    log = spark.read.schema(INCIDENT_SCHEMA).json(incident_path).select(*INCIDENT_SCHEMA.names)
    last = log.groupBy("incident_id").agg(F.max_by(F.struct(*INCIDENT_SCHEMA.names), "details.risk.score").alias("x"))
    return last.select("x.*")
