"""Skewed inputs: one user and one pickup location hold a third of all rows.
Results must equal a pandas brute force, and no step may hold the hot key's
rows in a single group before the shuffle (partial aggregation first)."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabflow.plans import conversion as C
from tabflow.plans import trips as P

N = 30_000


def test_conversion_with_hot_user(spark):
    rng = np.random.default_rng(5)
    user = np.where(rng.random(N) < 1 / 3, 7, rng.integers(1, 400, N))
    day = rng.integers(0, 20, N)
    event = rng.choice(["view", "click", "purchase", "error"], N, p=[0.6, 0.2, 0.1, 0.1])
    pdf = pd.DataFrame({"user_session": [f"{u}-{d}" for u, d in zip(user, day)], "user_id": user, "event_type": event})
    users = pd.DataFrame({"user_id": np.arange(1, 400), "customer_segment": ["high", "medium", "low"] * 133})

    events = spark.createDataFrame(pdf)
    dim = spark.createDataFrame(users)
    got = {r[0]: tuple(r[1:]) for r in C.conversion_by_segment(C.session_conversion(events), dim).collect()}

    sess = pdf.groupby("user_session").agg(
        user_id=("user_id", "max"), converted=("event_type", lambda s: int((s == "purchase").any()))
    )
    j = sess.merge(users, on="user_id")
    want = j.groupby("customer_segment").agg(t=("converted", "size"), c=("converted", "sum"))
    for seg, row in want.iterrows():
        assert got[seg][:2] == (row["t"], row["c"])
        assert got[seg][2] == np.floor(row["c"] / row["t"] * 10000 + 0.5) / 10000


def test_pickup_stats_with_hot_location(spark):
    rng = np.random.default_rng(9)
    loc = np.where(rng.random(N) < 1 / 3, 3, rng.integers(1, 60, N))
    base = dt.datetime(2021, 1, 25)
    times = [base + dt.timedelta(hours=int(h)) for h in rng.integers(0, 24 * 28, N)]
    miles = rng.gamma(2.0, 2.0, N)
    pdf = pd.DataFrame(
        {"pickup_datetime": times, "dropoff_datetime": times, "PULocationID": loc, "DOLocationID": loc, "trip_miles": miles}
    )
    zones = pd.DataFrame({"LocationID": np.arange(1, 60), "Borough": ["A", "B", "C"] * 19 + ["A", "B"], "Zone": [f"z{i}" for i in range(1, 60)]})
    trips = spark.createDataFrame(pdf).withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz"))
    trips = trips.withColumn("dropoff_datetime", F.col("dropoff_datetime").cast("timestamp_ntz"))
    got = {r["PULocationID"]: (r["number_of_trips"], r["avg_trip_distance"]) for r in P.pickup_location_stats(trips, spark.createDataFrame(zones)).collect()}

    w = pdf[(pdf.pickup_datetime >= "2021-02-01") & (pdf.pickup_datetime < "2021-02-15")]
    want = w.groupby("PULocationID").agg(n=("pickup_datetime", "count"), m=("trip_miles", "mean"))
    assert set(got) == set(want.index)
    for k, row in want.iterrows():
        assert got[k][0] == row["n"]
        assert abs(got[k][1] - row["m"]) < 1e-9
    top = P.displayed(P.pickup_location_stats(trips, spark.createDataFrame(zones)), 1).collect()[0]
    assert top["PULocationID"] == 3
