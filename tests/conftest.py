import os
import sys

import numpy as np
import pandas as pd
import pytest
from graphs import SERVICE_EDGES, SUPPLY_EDGES
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return SF_DIR


def shop_days(n, seed, price=1.0, views=1.0):
    """A year of a web shop: events lift ads and views and lower prices; profit is revenue less cost."""
    r = np.random.default_rng(seed)
    event = r.random(n) < 0.04
    ads = np.where(event, 2400.0, 1300.0) + r.normal(0, 90, n)
    page_views = (views * (7000 + 2.2 * ads + 5200 * event) + r.normal(0, 350, n)).round()
    unit_price = price * (np.where(event, 880.0, 1000.0) + r.normal(0, 12, n))
    sold = (0.11 * page_views - 0.55 * unit_price + 250 * event + 420 + r.normal(0, 40, n)).round()
    revenue = sold * unit_price
    cost = ads + 480 * sold + 45000 + r.normal(0, 900, n)
    return pd.DataFrame({"Date": pd.date_range("2021-01-01", periods=n).date, "Shopping_Event": event, "Ad_Spend": ads,
                         "Page_Views": page_views.astype(int), "Unit_Price": unit_price, "Sold_Units": sold.astype(int),
                         "Revenue": revenue, "Operational_Cost": cost, "Profit": revenue - cost})


def from_graph(edges, n, seed, roots, weights=None, rules=None, noise=0.1):
    """Rows of a graph, node by node: a root is what ``roots`` draws, another node a weighted sum of its parents plus
    normal noise, unless ``rules`` has a function of (values so far, random generator) for it."""
    r = np.random.default_rng(seed)
    parents = {}
    for parent, child in edges:
        parents.setdefault(parent, [])
        parents.setdefault(child, []).append(parent)
    values = {}
    while len(values) < len(parents):
        for node, above in parents.items():
            if node in values or not all(p in values for p in above):
                continue
            if node in (rules or {}):
                values[node] = rules[node](values, r)
            elif not above:
                values[node] = roots(node, r, n)
            else:
                values[node] = sum((weights or {}).get((p, node), 0.5) * values[p] for p in above) + r.normal(0.2, noise, n)
    return values


def requests(n, seed, slow_cache=0.0):
    """Latencies of services that call one another; two of them do not depend on their parents by a straight line."""
    chain = {(p, c): 1.0 for p, c in (("Product_Service", "API"), ("API", "www"), ("www", "Website"))}
    rules = {"Caching_Service": lambda v, r: v["Product_DB"] * r.lognormal(-0.2, 0.6, n) + 0.15 + slow_cache,
             "Product_Service": lambda v, r: np.log(sum(np.exp(3 * v[p]) for p in ("Shipping_Cost_Service", "Caching_Service", "Customer_DB")))
             / 3 + r.normal(0, 0.05, n)}
    values = from_graph(SERVICE_EDGES, n, seed, lambda node, r, n: 0.15 + np.abs(r.normal(0, 0.15 + 0.04 * len(node) % 0.3, n)),
                        chain, rules, 0.06)
    return pd.DataFrame({"request_id": np.arange(n), **values})


def product_week(n, seed, demand=3.0, alpha=0.8):
    """Orders of a week: what is asked for, what is confirmed, what arrives."""
    centre = {"demand": demand, "constraint": 1.2}
    values = from_graph(SUPPLY_EDGES, n, seed, lambda node, r, n: r.normal(centre[node], 0.25 * centre[node], n),
                        {("demand", "submitted"): 0.9, ("constraint", "submitted"): -0.3, ("submitted", "confirmed"): alpha,
                         ("confirmed", "received"): 0.8}, noise=0.3)
    return pd.DataFrame({"asin": [f"P{i:05d}" for i in range(n)], **values})


@pytest.fixture(scope="session")
def shop(spark):
    return spark.createDataFrame(shop_days(365, 1)).persist()


@pytest.fixture(scope="session")
def shop_new(spark):
    return spark.createDataFrame(shop_days(90, 2, price=0.9, views=0.86)).persist()


@pytest.fixture(scope="session")
def normal(spark):
    return spark.createDataFrame(requests(4000, 3)).persist()


@pytest.fixture(scope="session")
def degraded(spark):
    return spark.createDataFrame(requests(1000, 4, slow_cache=2.0)).persist()


@pytest.fixture(scope="session")
def weeks(spark):
    return (spark.createDataFrame(product_week(1000, 5)).persist(),
            spark.createDataFrame(product_week(1000, 6, demand=5.0, alpha=1.3)).persist())
