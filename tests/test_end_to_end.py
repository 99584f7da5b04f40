from pyspark.sql import functions as F

from lanwatch.operators import trust as TR
from lanwatch.plans import service


def test_end_to_end_chain(spark, packets):
    store = TR.upsert(TR.empty_store(spark), spark.createDataFrame(
        [("02:00:00:00:00:FE", "192.168.1.1", "gateway", 1)], "mac string, ip string, label string, seq long"), "t0")
    assessed, incidents, requests = service.end_to_end(packets, store, "2024-01-01T00:00:00+00:00",
                                                       n_trees=20)
    a = assessed.collect()
    inc = incidents.collect()
    req = requests.orderBy("request_id").collect()
    assert len(inc) == len(a) > 0
    assert len({r["incident_id"] for r in inc}) == len(inc)
    alerts = [r for r in inc if r["severity"] in ("HIGH", "CRITICAL")]
    assert sorted(int(r["request_id"].split("-")[1]) for r in req) == list(range(1, len(alerts) + 1))
    assert all(r["status"] == "PENDING" and r["action"] == "ISOLATE_DEVICE" for r in req)
    gw = [r for r in a if r["device_mac"] == "02:00:00:00:00:fe" and r["device_ip"] == "192.168.1.1"]
    assert gw and all(r["trusted"] for r in gw)
    assert all("Trusted-device adjustment applied" in r["risk"]["explanation"] for r in gw)
    # every event carries the window's forest verdict
    assert assessed.where(F.col("is_anomaly").isNull()).count() == 0
