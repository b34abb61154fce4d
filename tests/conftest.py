import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordertide import schema as S  # noqa: E402
from ordertide.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="ordertide-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="ordertide-test-", dir="/tmp")


def product(pid, price, name=None):
    return (pid, name or f"p{pid}", None if price is None else Decimal(str(price)))


def orders_df(spark, rows):
    """rows: (id, marketId, customerId, [prices] | None) -> OrderEvent frame with key, ts, seq."""
    data = []
    for i, (oid, m, c, prices) in enumerate(rows):
        prods = None if prices is None else [
            None if p == "NULL" else product(str(j), p) for j, p in enumerate(prices)]
        data.append((oid, oid, m, c, prods, i))
    schema = ("key string, id string, marketId string, customerId string, "
              "products array<struct<id:string,name:string,price:decimal(18,2)>>, seq long")
    from pyspark.sql import functions as F
    return spark.createDataFrame(data, schema).withColumn(
        "ts", F.timestamp_seconds(F.col("seq")).cast("timestamp_ntz"))


def full_df(spark, rows):
    """rows: (id, marketId, customerId, productCount, price, status, source, ts_seconds)."""
    from pyspark.sql import functions as F
    data = [(r[0], r[1], r[2], r[3], None if r[4] is None else Decimal(str(r[4])), r[5], r[6], r[7], i)
            for i, r in enumerate(rows)]
    schema = ("id string, marketId string, customerId string, productCount int, "
              "price decimal(18,2), status string, source string, t long, seq long")
    return (spark.createDataFrame(data, schema)
            .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t"))


__all__ = ["S", "orders_df", "full_df", "product"]
