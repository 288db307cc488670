"""Property tests against brute force on random small inputs (row order is
arbitrary, so these also check order-insensitivity)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.operators import alerts, dau

DAY = 1704067200000
MIDS = ["m1", "m2", "m3"]
UIDS = ["u1", "u2", "u3", "u4"]
EVIDS = ["coupon", "clickItem", "addCart"]

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

log_rows = st.lists(
    st.tuples(st.sampled_from(MIDS), st.sampled_from(UIDS), st.integers(0, 3 * 86_400_000 - 1)),
    min_size=1, max_size=40,
)


@SETTINGS
@given(rows=log_rows)
def test_first_per_day_matches_brute_force(spark, rows):
    data = [(i, "startup", m, u, "a", DAY + t, None, None) for i, (m, u, t) in enumerate(rows)]
    df = spark.createDataFrame(
        data, "log_id long, type string, mid string, uid string, area string, ts long, evid string, itemid string")
    got = {(r["mid"], r["logdate"]): (r["ts"], r["uid"], r["log_id"]) for r in dau.first_start_per_day(df).collect()}
    want: dict = {}
    for log_id, _, m, u, _, ts, _, _ in data:
        day = f"2024-01-{1 + (ts - DAY) // 86_400_000:02d}"
        cand = (ts, u, log_id)
        if (m, day) not in want or cand < want[(m, day)]:
            want[(m, day)] = cand
    assert got == want


event_rows = st.lists(
    st.tuples(st.sampled_from(MIDS), st.sampled_from(UIDS), st.sampled_from(EVIDS),
              st.sampled_from(["i1", "i2"]), st.integers(0, 90_000)),
    min_size=1, max_size=40,
)


@SETTINGS
@given(rows=event_rows)
def test_alerts_match_brute_force(spark, rows):
    size, slide = 30_000, 5_000
    data = [(m, u, e, i, DAY + t) for m, u, e, i, t in rows]
    df = spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts long")
    got = {(r["mid"], r["ts"]): (r["uids"], r["item_ids"], r["events"]) for r in alerts.coupon_alerts(df).collect()}

    groups = defaultdict(list)
    for m, u, e, i, ts in data:
        start = ts - ts % slide
        for k in range(size // slide):
            groups[(m, start - k * slide)].append((u, e, i))
    want = {}
    for (m, start), evs in groups.items():
        uids = sorted({u for u, e, _ in evs if e == "coupon"})
        items = sorted({i for _, e, i in evs if e == "coupon"})
        if len(uids) >= 3 and not any(e == "clickItem" for _, e, _ in evs):
            counts = defaultdict(int)
            for _, e, _ in evs:
                counts[e] += 1
            bag = ",".join(sorted(f"{e}:{n}" for e, n in counts.items()))
            want[(m, start + size)] = (",".join(uids), ",".join(items), bag)
    assert got == want
