import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lanwatch.session import local_session
    s = local_session("4", shuffle_partitions=8, app="lanwatch-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def packets(spark):
    from lanwatch.sources import fixture
    return fixture.packets(spark, SF001)


@pytest.fixture(scope="session")
def labelled(spark):
    from lanwatch.sources import fixture
    return fixture.packets_with_label(spark, SF001)


def make_packets(spark, rows):
    """rows: (seq, ts_us, op, src_mac, dst_mac, src_ip, dst_ip)"""
    from lanwatch.schema import PACKET_SCHEMA
    return spark.createDataFrame(rows, PACKET_SCHEMA)
